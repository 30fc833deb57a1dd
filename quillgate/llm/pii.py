"""Personal data by a skip-chain conditional random field.

Exact patterns find the base spans.  The field runs over the tokens that hold a
digit or an @ or are a user name of the text: neighbours in the text share a chain potential, and repeated or
similar tokens of a document, however distant and many, share a skip potential
with one variable (a hub), which is observed if one of them is.  Base
spans are observed; loopy message passing carries their labels to tokens that
no pattern matches (a number again without its prefix, a user name without its
host).  Potentials are log ratios of counts over the whole corpus, labelled by
the base spans.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillgate.llm import common as c

KINDS = ("email", "ip", "card", "phone")
OTHER = 0  # label 0; label i + 1 is KINDS[i]
LABELS = len(KINDS) + 1
SHAPES = 2048
#: messages go on until none changes more than this, or swing so long
SETTLED = 1e-3
MOST_ROUNDS = 500
DAMPING = 0.3
#: log weight against a kind for a token that no pattern matched
DOUBT = 4.0
THRESHOLD = 0.6
#: log weight of a link against different labels
DISSENT = 3.0
#: a form that was never seen with a kind speaks against it this much
STRANGE = 1.0
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin with a run of digits, hence the look-behind: long runs stay linear
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIM = "\"'()[]{}<>.,;:!?*#%&$|=-"
_LETTER, _JOINT = re.compile(r"[a-z]"), re.compile(r"[a-z0-9][._+-][a-z0-9]|[0-9]")
_RUN = re.compile(r"[0-9]+|[^\W\d_]+")

SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def emails(text: str):
    """Each @ with what can stand before it (not before the last match's end)
    and behind it: what leftmost matching finds, in linear time."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", max(at + 1, floor))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start; code points."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(x.isdigit() for x in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


def shape(token: str) -> int:
    """Number of the token's form: letters as a, digits as their count."""
    form = _RUN.sub(lambda m: f"9{min(len(m[0]), 20)}" if m[0][0].isdigit() else "a", token)
    return zlib.crc32(form.encode()) % SHAPES


def user_name(token: str) -> str | None:
    """The part before the @, if it can stand for a person without its host:
    a plain number or a plain word is too much like others."""
    name, at, _ = token.lower().partition("@")
    return name if at and len(name) >= 4 and _LETTER.search(name) and _JOINT.search(name) else None


def links(token: str, whole: bool = True) -> list[str]:
    """What makes two tokens of a document alike.  A piece of a longer base
    span (not ``whole``) is alike by its digits alone, if they are many: a
    prefix or a group of four says nothing about an equal number elsewhere."""
    low = token.lower()
    out = [low] if whole else []
    digits = "".join(x for x in low if "0" <= x <= "9")
    if len(digits) >= 7:
        out.append("#" + digits)
    name = user_name(token) if whole else None
    if name:
        out.append(name)
    return out


@dataclass
class Tokens:
    """Candidate tokens of the texts of a slice, and the field's edges."""

    text: list[int]
    start: list[int]
    end: list[int]
    label: list[int]
    form: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]  # each token and the last one alike, to count from
    hub: list[tuple[int, int]]  # (hub, token): one hub for what is repeated
    hubs: int = 0


def named(part: c.Slice, texts: dict[int, str], base: dict[int, list], starts, ends, owner, points) -> np.ndarray:
    """Words without a digit or an @ that are a user name of the same text."""
    out: list[int] = []
    for i, spans in base.items():
        names = {user_name(texts[i][a:b]) for k, a, b in spans if k == 0} - {None}
        names = {x for x in names if not any(d.isdigit() for d in x)}
        if names:
            zero = points[part.start[i] + 1]
            for w in range(*np.searchsorted(owner, [i, i + 1]).tolist()):
                token = texts[i][int(points[starts[w]] - zero) : int(points[ends[w]] - zero)]
                if token.strip(_TRIM).lower() in names:
                    out.append(w)
    return np.array(out, np.int64)


def tokens(part: c.Slice, texts: dict[int, str], base: dict[int, list]) -> Tokens:
    """``texts``: decoded texts that hold a digit or an @, by number."""
    out = Tokens([], [], [], [], [], [], [], [])
    starts, ends, owner = part.words()
    mark = np.concatenate([[0], np.cumsum(c.DIGIT[part.data] | (part.data == 0x40))])
    words = np.flatnonzero(mark[ends] > mark[starts])
    points = np.concatenate([[0], np.cumsum((part.data & 0xC0) != 0x80)])
    words = np.union1d(words, named(part, texts, base, starts, ends, owner, points))
    text_of, word_number = -1, -2
    last: dict[str, int] = {}
    hub_of: dict[str, int] = {}
    for w in words.tolist():
        i = int(owner[w])
        if i != text_of:
            text_of, last, hub_of, word_number = i, {}, {}, -2
        zero = points[part.start[i] + 1]
        a, b = int(points[starts[w]] - zero), int(points[ends[w]] - zero)
        token = texts[i][a:b]
        lead = len(token) - len(token.lstrip(_TRIM))
        token = token.strip(_TRIM)
        if not token:
            continue
        a += lead
        b = a + len(token)
        span = next((x for x in base[i] if x[1] < b and a < x[2]), None)
        kind = span[0] + 1 if span else OTHER
        me = len(out.text)
        if word_number == w - 1:
            out.chain.append((me - 1, me))
        word_number = w
        for key in links(token, not span or a <= span[1] and span[2] <= b):
            if key in last and last[key] != me:
                out.skip.append((last[key], me))
                if key not in hub_of:
                    hub_of[key] = out.hubs
                    out.hub.append((out.hubs, last[key]))
                    out.hubs += 1
                out.hub.append((hub_of[key], me))
            last[key] = me
        for values, v in zip((out.text, out.start, out.end, out.label, out.form), (i, a, b, kind, shape(token))):
            values.append(v)
    return out


def read(part: c.Slice, raw: list[bytes]) -> tuple[dict[int, str], dict[int, list]]:
    """Decoded texts that may hold anything, and their base spans."""
    mark = np.concatenate([[0], np.cumsum(c.DIGIT[part.data] | (part.data == 0x40))])
    some = np.flatnonzero(mark[part.stop] > mark[part.start])
    texts = {int(i): raw[part.lo + i].decode("utf-8", "replace") for i in some}
    return texts, {i: base_spans(t) for i, t in texts.items()}


def _observe(batches):
    shapes = np.zeros((SHAPES, LABELS), np.int64)
    pairs = {"chain": np.zeros((LABELS, LABELS), np.int64), "skip": np.zeros((LABELS, LABELS), np.int64)}
    for batch in batches:
        raw = c.as_bytes(batch.column("text"))
        for part in c.slices(raw):
            found = tokens(part, *read(part, raw))
            label = np.array(found.label, int)
            np.add.at(shapes, (np.array(found.form, int), label), 1)
            for name, edges in (("chain", found.chain), ("skip", found.skip)):
                if edges:
                    u, v = np.array(edges).T
                    np.add.at(pairs[name], (label[u], label[v]), 1)
    for name, table in {"shape": shapes, **pairs}.items():
        a, b = np.nonzero(table)
        yield {"what": [name] * len(a), "a": a, "b": b, "n": table[a, b]}


@dataclass
class Field:
    unary: np.ndarray  # (SHAPES, LABELS), logs
    chain: np.ndarray  # (LABELS, LABELS), logs
    skip: np.ndarray


def train(docs: DataFrame, text: str = "text") -> Field:
    """Potentials from all texts; the driver gets at most a row for each shape
    and label and for each pair of labels."""
    got = c.over_batches(c.narrow(docs, text=text), _observe, "what string, a int, b int, n long")
    got = got.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).toPandas()
    tables = {"shape": np.zeros((SHAPES, LABELS)), "chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}
    for what, a, b, n in got.itertuples(index=False):
        tables[what][a, b] = n
    prior = tables["shape"].sum(axis=0) + 1
    prior /= prior.sum()
    unary = np.log(tables["shape"] + 5 * prior) - np.log((tables["shape"] + 5 * prior).sum(axis=1, keepdims=True))

    def ratio(table: np.ndarray) -> np.ndarray:
        both = table + table.T + 1.0
        both /= both.sum()
        alone = both.sum(axis=1)
        return np.log(both / np.outer(alone, alone))

    # A link speaks for equal labels and against different ones, however seldom
    # it was seen; but less for a kind than DOUBT speaks against it, so that
    # copies of one token never talk each other into it without an observed one.
    skip = np.clip(ratio(tables["skip"]), -DISSENT, DOUBT - 0.5)
    same = np.eye(LABELS, dtype=bool)
    skip = np.where(same, np.maximum(skip, DOUBT - 0.5), np.minimum(skip, -DISSENT))
    skip[0, 0] = 0.0
    return Field(unary, np.clip(ratio(tables["chain"]), -1, 1), skip)


def posteriors(field: Field, found: Tokens) -> np.ndarray:
    """Label probabilities of the tokens by damped sum-product rounds; the
    tokens of many documents at once, as no edge joins two documents."""
    label = np.array(found.label, int)
    node = field.unary[np.array(found.form, int)].copy() if len(label) else np.zeros((0, LABELS))
    node = np.clip(node - node[:, :1], -STRANGE, 0.0) - DOUBT
    node[:, 0] = 0.0
    seen = label > 0
    node[seen] = -50.0
    node[np.flatnonzero(seen), label[seen]] = 0.0
    hub, member = np.array(found.hub, int).reshape(-1, 2).T
    votes = np.zeros((found.hubs, LABELS))
    np.add.at(votes, (hub, label[member]), label[member] > 0)
    # an unobserved hub is doubted as its tokens are
    hubs = np.full((found.hubs, LABELS), -DOUBT)
    hubs[:, 0] = 0.0
    told = votes.any(axis=1)
    hubs[told] = -1e9  # beyond any number of tokens
    hubs[told, votes[told].argmax(axis=1)] = 0.0
    tokens_, node = len(node), np.concatenate([node, hubs])
    edges = np.concatenate([np.array(found.chain, int).reshape(-1, 2), np.stack([tokens_ + hub, member], axis=1)])
    if not len(edges):
        return _normal(node)
    pair = np.concatenate([np.repeat(field.chain[None], len(found.chain), 0), np.repeat(field.skip[None], len(found.hub), 0)])
    u, v = edges.T
    to_v, to_u = np.zeros((len(u), LABELS)), np.zeros((len(u), LABELS))
    for _ in range(MOST_ROUNDS):
        before = to_v, to_u
        belief = node.copy()
        np.add.at(belief, v, to_v)
        np.add.at(belief, u, to_u)
        new_v = _log_sum((belief[u] - to_u)[:, :, None] + pair)
        new_u = _log_sum(((belief[v] - to_v)[:, None, :] + pair).transpose(0, 2, 1))
        to_v = DAMPING * to_v + (1 - DAMPING) * (new_v - new_v.max(axis=1, keepdims=True))
        to_u = DAMPING * to_u + (1 - DAMPING) * (new_u - new_u.max(axis=1, keepdims=True))
        if max(np.abs(to_v - before[0]).max(), np.abs(to_u - before[1]).max()) < SETTLED:
            break
    belief = node.copy()
    np.add.at(belief, v, to_v)
    np.add.at(belief, u, to_u)
    return _normal(belief[:tokens_])


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=1)) + top[:, 0]


def _normal(belief: np.ndarray) -> np.ndarray:
    p = np.exp(belief - belief.max(axis=1, keepdims=True, initial=-1e9))
    return p / p.sum(axis=1, keepdims=True) if len(p) else p


def spans_of(field: Field, part: c.Slice, raw: list[bytes]) -> tuple[dict[int, str], dict[int, list]]:
    """Texts, and all spans (kind, start, end, base) of each."""
    texts, base = read(part, raw)
    found = tokens(part, texts, base)
    p = posteriors(field, found)
    out = {i: [(*s, True) for s in spans] for i, spans in base.items()}
    best = p.argmax(axis=1) if len(p) else np.zeros(0, int)
    for at in np.flatnonzero((best > 0) & (np.array(found.label, int) == OTHER)):
        if p[at, best[at]] >= THRESHOLD:
            out[found.text[at]].append((int(best[at]) - 1, found.start[at], found.end[at], False))
    return texts, {i: sorted(s) for i, s in out.items()}


def redact(text: str, spans: list) -> str:
    """Every span as its kind in brackets; overlapping ones as the first's."""
    out, at = [], 0
    for start, end, kind in sorted((s[1], s[2], s[0]) for s in spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, field: Field, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The columns of ``keep``, ``spans`` (kind, start, end, base; by kind,
    then start) and ``redacted`` for every row of ``docs``.

    A null text is empty: no spans, and null again in ``redacted``.  Texts are
    read whole; offsets count code points, ends are exclusive.  Repeated rows
    give repeated results.  Spans that the field adds never touch base ones.
    """
    rows = docs.select(F.struct(F.lit(0).alias("_0"), *(keep or [])).alias("_keep"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches):
        for batch in batches:
            raw = c.as_bytes(batch.column("text"))
            spans: list[list] = [[]] * len(raw)
            clean = batch.column("text").to_pylist()
            for part in c.slices(raw):
                texts, found = spans_of(shared.value, part, raw)
                for i, s in found.items():
                    if s:
                        spans[part.lo + i] = [{"kind": KINDS[k], "start": a, "end": b, "base": x} for k, a, b, x in s]
                        clean[part.lo + i] = redact(texts[i], s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_keep"), pa.array(spans, pa.list_(kind)), pa.array(clean, pa.string())], names=["_keep", "spans", "redacted"])

    got = rows.mapInArrow(run, f"_keep {dict(rows.dtypes)['_keep']}, spans {SPAN}, redacted string")
    names = [f"_keep.`{f.name}`" for f in rows.schema["_keep"].dataType.fields if f.name != "_0"]
    return got.select(*names, "spans", "redacted")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
