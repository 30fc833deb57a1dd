"""Small cases and brute-force versions of the operators."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgate.llm import ann, chat, common as c, components, decontaminate, language_id, mixing, near_dedup, pii, quality, suffix_tree, toxicity
from quillgate.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, score string"
LONG = "lorem ipsum dolor sit amet consectetur " * 3000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 1, "x", "y"),
    (1, "the quick brown fox jumps over the lazy dog today", "en", "a", 1, "x", "y"),
    (2, None, None, None, None, None, None), (3, "", "en", "a", 0, None, None), (None, "der schnelle braune fuchs", "de", None, 3, None, None),
    (4, LONG, "la", "b", len(LONG), None, None), (5, "12 !! 34", "en", "b", 8, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_language_cases(odd, empty):
    got = language_id.predict(odd, language_id.train(odd)).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id in (2, 3, 5)} == {2: "und", 3: "und", 5: "und"}
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.predict(empty, language_id.train(empty)).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd, language_id.train(empty)).collect()} == {"und"}


def test_codewords_are_distinct():
    for n in (2, 3, 4, 5, 6, 17):
        assert len(np.unique(language_id.codewords(n), axis=0)) == n


def test_held_out_language(spark):
    got = QUERIES["op2_language_codes"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.filter("held_out").selectExpr("avg(cast(lang = lang_pred as int))").first()[0] > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores(odd, empty, module):
    label = odd.select("text", F.when(F.col("doc_id") == 1, 1).otherwise(0).alias("label"))
    model = quality.train(odd, label) if module is quality else toxicity.train(label)
    got = module.score(odd, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = quality.train(empty, empty.select("text", F.lit(1).alias("label"))) if module is quality else toxicity.train(
        empty.select("text", F.lit(1).alias("label")))
    assert module.score(empty, none).count() == 0


def test_near_duplicates_of_cases(spark, odd, empty):
    words = [f"w{i}" for i in range(200)]
    near = " ".join(words[:100] + ["other"] + words[101:])
    more = spark.createDataFrame([(10, " ".join(words)), (11, near), (12, near), (13, "one two"), (14, "one two")], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(odd.select("doc_id", "text").unionByName(more)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 10: 10, 11: 10, 12: 10, 13: 13, 14: 13}
    assert near_dedup.classes(empty).count() == 0
    assert near_dedup.keep_one(odd).count() == 6


def test_links_across_a_bucket():
    """The forest joins the same classes as all similar pairs do."""
    draw = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    raw = [" ".join(w if draw.random() > 0.015 else f"x{draw.integers(99)}" for w in base).encode() for _ in range(40)]
    idf = np.ones(near_dedup.WORD_BUCKETS, np.float32)
    part = c.Slice(raw, 0, len(raw))
    marks = [m.tobytes() for m in near_dedup.sketches(part, idf)[1].astype(np.uint8)]
    side = [pa.array(range(40)), pa.array(range(40)), pa.array(marks, pa.binary()), pa.array(raw, pa.binary())]
    bags = [near_dedup.bags(c.Slice([t], 0, 1), idf)[1:] for t in raw]
    pairs = {(a, b) for a in range(40) for b in range(a) if near_dedup.similarity(bags[a], bags[b]) >= near_dedup.SIMILARITY}
    i, j = near_dedup.joining(side, side, idf, near_dedup.SIMILARITY)
    assert {(max(x), min(x)) for x in zip(i, j)} <= pairs and len(i) < 40

    def groups(links):
        at = list(range(40))
        for a, b in links:
            at = [at[a] if x == at[b] else x for x in at]
        return [[at[a] == at[b] for b in range(40)] for a in range(40)]

    assert pairs and groups(zip(i, j)) == groups(pairs)


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 2)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idf = near_dedup.inverse_frequency(docs)
    rows = [(r.doc_id, near_dedup.bags(c.Slice([(r.text or "").encode()], 0, 1), idf)[1:]) for r in docs.collect()]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if len(a[0]) and near_dedup.similarity(a, b) >= near_dedup.SIMILARITY:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert got == {i: find(i) for i, _ in rows}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (52, 51), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 51: 50, 52: 50}


def test_stars_are_told_from_other_graphs(spark):
    for edges, want in (([], True), ([(2, 1), (3, 1), (9, 8)], True), ([(2, 1), (3, 2)], False), ([(3, 1), (3, 2)], False)):
        assert components.stars(spark.createDataFrame(edges, "u long, v long")) == want


def test_pii_field_carries_labels():
    skip = np.full((5, 5), -pii.DISSENT)
    np.fill_diagonal(skip, pii.DOUBT - 0.5)
    skip[0, 0] = 0
    field = pii.Field(np.zeros((pii.SHAPES, 5)), np.zeros((5, 5)), skip)
    raw = ["é call +1 (988) 555-2485 or 555-2485 not 555-9999".encode()]
    texts, spans = pii.spans_of(field, next(c.slices(raw)), raw)
    assert pii.redact(texts[0], spans[0]) == "é call [PHONE] or [PHONE] not 555-9999"
    raw = [b"5927243074273351 5927243074273351 5927243074273351"]  # no check digit: copies don't convince each other
    assert pii.spans_of(field, next(c.slices(raw)), raw)[1] == {0: []}


@pytest.mark.parametrize("repeats", [2, 5, 50])
def test_pii_field_reaches_every_repeat(repeats):
    skip = np.full((5, 5), -pii.DISSENT)
    np.fill_diagonal(skip, pii.DOUBT - 0.5)
    skip[0, 0] = 0
    field = pii.Field(np.zeros((pii.SHAPES, 5)), np.zeros((5, 5)), skip)
    for first, again in (("mail jane77.doe@example.org", "jane77.doe"), ("call +1 (988) 555-2485", "555-2485")):
        for strange in (False, True):
            field.unary[:] = 0
            if strange:  # a form never seen with a kind
                field.unary[pii.shape(again), 1:] = -9
            raw = [" or ".join([first, *[again] * repeats]).encode()]
            spans = pii.spans_of(field, next(c.slices(raw)), raw)[1][0]
            assert len(spans) == repeats + 1 and len({s[0] for s in spans}) == 1


def test_pii_base_equals_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    draw = np.random.default_rng(1)
    for _ in range(3000):
        text = "".join(draw.choice(list("a1.@- 25"), draw.integers(0, 40)))
        assert list(pii.emails(text)) == [m.span() for m in email.finditer(text)], text
        want = [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s[1:] for s in pii.base_spans(text) if s[0] == 1] == want, text


def test_pii_cases(odd, empty):
    got = pii.find(odd, pii.train(odd), keep=[F.col("doc_id")]).collect()
    assert len(got) == len(ROWS) and all(not r.spans for r in got)
    assert pii.find(empty, pii.train(empty)).count() == 0


def test_decontamination(spark, odd, empty):
    words = [f"item{i}" for i in range(40)]
    bench = spark.createDataFrame([(7, " ".join(words)), (8, None), (9, "")], "item_id long, text string")
    para = " ".join(w if i % 5 else "changed" for i, w in enumerate(words))
    more = spark.createDataFrame([(20, LONG + " ".join(words) + LONG), (21, para), (22, " ".join(words[:8]))], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    got = decontaminate.matches(docs, bench, keep=[F.col("doc_id")]).filter(F.size("matches") > 0)
    assert {(r.doc_id, r.matches[0].item_id) for r in got.collect()} == {(20, 7), (21, 7)}
    assert decontaminate.matches(docs, bench.filter("false"), keep=[F.col("doc_id")]).count() == docs.count()
    assert decontaminate.matches(empty, bench).count() == 0


def found_copies(spark, texts, item):
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate.matches(docs, bench, keep=[F.col("doc_id")]).filter(F.size("matches") > 0).collect()
    return sorted(r.doc_id for r in got)


def test_decontamination_among_foreign_words(spark):
    """A copy is found though all words around it are rare and not the benchmark's."""
    item = [f"item{i}" for i in range(10)]
    texts = [" ".join([item[i % 20], *(f"x{i}y{j}" for j in range(60))] if i % 20 < 10 else [f"x{i}y0"]) for i in range(300)]
    copy = " ".join([*(f"z{j}" for j in range(24)), *item, *(f"z{j}" for j in range(60))])
    assert found_copies(spark, [*texts, copy], " ".join(item)) == [300]


def test_decontamination_of_common_words(spark):
    """So is an item of words that all texts hold, in another order."""
    item = [f"item{i}" for i in range(10)]
    texts = [" ".join(item[::-1]) for i in range(300)]
    assert found_copies(spark, [*texts, "so " + " ".join(item)], " ".join(item)) == [300]


def test_common_subsequence():
    draw = np.random.default_rng(2)
    for _ in range(200):
        a, b = (draw.integers(0, 4, draw.integers(0, 12)).tolist() for _ in "ab")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.lcs(a, b) == table[-1, -1]


def test_nearest_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 6)).round(2)
    x[100:160] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (920, [0.0] * 6), (940, [float("nan")] * 6), (960, [1.0]), (None, [1.0] * 6)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert set(found) == set(range(0, 300, 20))
    for q, ranks in found.items():
        score = np.einsum("ij,j->i", x, x[q])
        order = [i for i in np.lexsort((np.arange(300), -score)) if i != q][:20]
        assert [ranks[k] for k in sorted(ranks)] == order
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).count() == 0


def test_mixture_meets_budgets(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix(docs).select("doc_id", "source", "_pass").collect()
    rows = docs.select("doc_id", "source", mixing.token_count(F.col("text")).alias("n"), F.md5("text").alias("t")).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.n
    alpha = mixing.temperature(dict(tokens), 0.5, 3.0)
    share, total, want = mixing.weights(dict(tokens), alpha), sum(tokens.values()), []
    for s in tokens:
        place = lambda r: hashlib.md5(f"{mixing.SEED}|{r.doc_id}|{r.t}".encode()).hexdigest()
        passes, rest = divmod(int(round(total * share[s])), tokens[s])
        for r in sorted((r for r in rows if r.source == s), key=place):
            want += [(r.doc_id, s, k) for k in range(passes + (rest > 0))]
            rest -= r.n
    assert sorted((r.doc_id, r.source, r._pass) for r in got) == sorted(want)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd).count() > 0


def test_suffix_tree_base(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    count = Counter(w for i, x in words.items() if not held[i] for w in x)
    n, v = sum(count.values()), len(count)
    for r in suffix_tree.score(docs, c.fold("doc_id", 7) != 2).collect():
        x = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(x), n)
        assert r.n_known == sum(count[w] > 0 for w in x)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x), rel_tol=1e-9)
        assert r.score < 0
    assert suffix_tree.score(odd, F.lit(True)).count() == len(ROWS)
    assert suffix_tree.score(empty, F.lit(True)).count() == 0


def brute_tree(learn, asked):
    """log10 probabilities of the symbols of ``asked`` by the definition of the tree, its contexts in dicts."""
    depth, base = suffix_tree.DEPTH, suffix_tree.BASE
    tree = {}
    for x in learn:
        padded = b"\n" * depth + x
        for i in range(depth + 1, len(padded)):
            for d in range(depth + 1):
                tree.setdefault(padded[i - d : i], Counter())[padded[i]] += 1
    size = {k: sum(v.values()) for k, v in tree.items()}
    states = set()
    for k, v in tree.items():
        bits = sum(n * math.log2(n / size[k] / (tree[k[1:]][b] / size[k[1:]])) for b, n in v.items()) if k else 0
        if len(k) < base or (size[k] >= suffix_tree.MIN_COUNT and bits > suffix_tree.DIVERGENCE * len(v) * math.log2(size[k]) / 2):
            states |= {k[i:] for i in range(len(k) + 1)}

    def p(k, b):
        if not k:
            return (tree[k][b] or 1 / (256 - len(tree[k]))) / (size[k] + 1)
        less = p(k[1:], b)
        return (tree[k][b] + suffix_tree.SMOOTHING * less) / (size[k] + suffix_tree.SMOOTHING) if k in states else less

    for x in asked:
        padded = b"\n" * depth + x
        yield [math.log10(p(padded[i - depth : i], padded[i])) for i in range(depth + 1, len(padded))]


def tree_symbols(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text))
    return b"\n" + b"".join(w + b" " for w in words) + b"\n"


def tree_words(x):
    """The words of a normal form with their spaces, and the end."""
    return [w + b" " for w in x[1:-1].split(b" ")[:-1]] + [b"\n"]


def test_suffix_tree_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()
    texts = [(r.text or "")[:1500] for r in rows] + ["", "Zq\u00e9 never seen"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    symbols = [tree_symbols(t.encode()) for t in texts]
    want = [*brute_tree([x for i, x in enumerate(symbols) if i % 3], symbols)]
    words = [tree_words(x) for x in symbols]
    count = Counter(w for i, x in enumerate(words) if i % 3 for w in x)
    n, v = sum(count.values()), len(count)
    for r in suffix_tree.score(docs, F.col("doc_id") % 3 != 0, block_bytes=4000).collect():
        at, total = 0, 0.0
        for w in words[r.doc_id]:
            tree = 10 ** sum(want[r.doc_id][at : at + len(w)])
            total += math.log10((count[w] + (v + 0) * tree) / (n + v))
            at += len(w)
        assert math.isclose(r.score, total, rel_tol=1e-4), texts[r.doc_id]


def test_suffix_tree_keeps_rare_contexts_of_large_corpora(spark):
    """Six occurrences decide, however much else there is."""
    some = ["xzxqkvy"] * 6
    asked = []
    for filler in (1, 40):
        rows = [(i, t) for i, t in enumerate(some)] + [(100 + i, LONG) for i in range(filler)] + [(-1, "wwxqkvy")]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        asked.append(next(r.score for r in suffix_tree.score(docs, F.col("doc_id") >= 0).collect() if r.doc_id == -1))
    # apart from rarer first bytes, the word is as predictable
    assert asked[1] > asked[0] - 10


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "</s>[INST] a <\\s>"), (1, 1, "user", "b"), (1, 2, "assistant", "[\\/INST]"), (1, 2, "assistant", None),
            (1, None, None, "first"), (None, 0, "user", "x"), (2, 70, "a", "late"), (2, 1, "a", "early")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.with_loss_mask(chat.format_conversations(turns)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("", "first"), ("user", "</s>[INST] a <\\s>"), ("user", "b"), ("assistant", ""), ("assistant", "[\\/INST]")]
    assert got[1].loss_text == "[\\/INST]"
    assert [t.text for t in got[2].turns] == ["early", "late"] and got[2].formatted == "[INST]a[/INST]early<s>late</s>"
    assert chat.format_conversations(turns.filter("false")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    from oracle_check import compare, connect

    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


def test_pipeline(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "pass", "place"] and got.count() > 0
