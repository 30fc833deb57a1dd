"""Reworded benchmark items, the word index, and spans of the field that must not be."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgate.llm import common as c, decontaminate, pii

ITEM = " ".join(f"item{i}" for i in range(22)) + ". " + " ".join(f"answer{i}" for i in range(8))


def found(spark, texts, items, **kw):
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    got = decontaminate.matches(docs, bench, keep=[F.col("doc_id")], **kw).filter(F.size("matches") > 0).collect()
    return {(r.doc_id, m.item_id) for r in got for m in r.matches}


def test_reworded_items_need_the_cosine(spark):
    """Order turned round, or more than half of the words replaced, with the
    answer: only the latent search finds these; without the answer, or with
    the answer alone, a text is clean."""
    words = [f"item{i}" for i in range(22)]
    answer = " ".join(f"answer{i}" for i in range(8))
    few = " ".join(w if i % 4 == 0 else f"other{i}" for i, w in enumerate(words))
    texts = [f"{' '.join(words[::-1])} {answer}", f"{few} {answer}", " ".join(words[::-1]), f"so {answer}",
             *(" ".join(f"w{i}x{j}" for j in range(40)) for i in range(60))]
    items = [ITEM, *(" ".join(f"w{100 + i}x{j}" for j in range(30)) for i in range(20))]
    assert found(spark, texts, items) == {(0, 0), (1, 0)}
    assert found(spark, texts, items, cosine=9.0) == set()


def test_recall_in_a_full_block(spark):
    """Of 2,000 items that share words, every verbatim copy and every copy with a
    quarter of its words changed is found, each for its own item."""
    draw = np.random.default_rng(7)
    items = [" ".join(f"v{x}" for x in draw.integers(0, 3000, 24)) for _ in range(2000)]
    planted = {}
    texts = []
    for i in range(0, 2000, 10):
        w = items[i].split()
        if i % 20:
            for j in draw.choice(19, 6, replace=False):  # the answer, the last five words, stays
                w[j] = f"changed{i}x{j}"
        around = [f"v{x}" for x in draw.integers(0, 3000, 60)]
        planted[len(texts)] = i
        texts.append(" ".join([*around[:30], *w, *around[30:]]))
    texts += [" ".join(f"v{x}" for x in draw.integers(0, 3000, 80)) for _ in range(300)]
    assert found(spark, texts, items) == set(planted.items())


def test_places_equal_brute_force():
    """The places to look at: those around one of an item's rarest words that hold enough of its words."""
    draw = np.random.default_rng(3)
    word = lambda n, k: [f"w{x}" for x in draw.integers(0, k, n)]
    items = [decontaminate.Item(i, decontaminate.of_text(" ".join(word(n, 30))), []) for i, n in enumerate([1, 3, 5, 8, 20, 20])]
    texts = [" ".join(word(n, 40)) for n in (0, 3, 30, 200)]
    texts += [f"{' '.join(word(20, 60))} {' '.join(word(8, 30))}", " ".join(["w1"] * 400)]
    part = c.Slice([t.encode() for t in texts], 0, len(texts))
    h, text = decontaminate.word_hashes(part)
    count = np.bincount(decontaminate.bucket(h), minlength=decontaminate.BUCKETS).astype(float)
    index = decontaminate.Index.of(items, count)
    first, stop = np.searchsorted(text, np.arange(part.n)), np.searchsorted(text, np.arange(part.n), "right")
    cut = decontaminate.halves(text)
    got = set(zip(*(x.tolist() for x in index.places(decontaminate.bucket(h), cut, first, stop))))
    want = set()
    for n, item in enumerate(items):
        size = len(item.words)
        need = size if size < decontaminate.SHORT else -(-size // 2)
        rarest = sorted(item.words, key=lambda x: count[decontaminate.bucket(np.array([x], np.uint64))[0]])[: size - need + 1]
        for half in range(len(cut.word)):
            mine = h[cut.of_word == half].tolist()
            a, z = decontaminate.region(int(cut.word[half]), size, first[cut.text[half]], stop[cut.text[half]])
            around = set(h[a:z].tolist())
            if set(mine) & set(rarest) and sum(w in around for w in item.words) >= need:
                want.add((half, n))
    assert got == want and want


def field():
    skip = np.full((pii.LABELS, pii.LABELS), -pii.DISSENT)
    np.fill_diagonal(skip, pii.DOUBT - 0.5)
    skip[0, 0] = 0
    return pii.Field(np.zeros((pii.SHAPES, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), skip)


@pytest.mark.parametrize("text, want", [
    ("tel +49 30 1234567 office. 30 people came on day 30 at 30 degrees", "tel [PHONE] office. 30 people came on day 30 at 30 degrees"),
    ("card 4111 1111 1111 1111 in year 1111 and 4111 too", "card [CARD] in year 1111 and 4111 too"),
    ("mail 2024@x.org in 2024", "mail [EMAIL] in 2024"),
    ("mail office@x.org, our office is shut", "mail [EMAIL], our office is shut"),
    ("mail jane.doe@x.org; é jane.doe, Jane.Doe. jane", "mail [EMAIL]; é [EMAIL], [EMAIL]. jane"),
    ("call +49 30 1234567 or 1234567, house 49", "call [PHONE] or [PHONE], house 49"),
    ("host 10.1.2.3 is 10.1.2.3 and 10", "host [IP] is [IP] and 10"),
])
def test_pii_links_whole_spans(text, want):
    raw = [b"", text.encode(), b"nothing here"]
    texts, spans = pii.spans_of(field(), next(c.slices(raw)), raw)
    assert pii.redact(texts[1], spans[1]) == want


def test_a_slice_is_hashed_once_and_hopeless_places_are_not_compared(monkeypatch):
    """Words are hashed once a slice; a place that lacks the words for a leak costs no subsequence."""
    many = [f"item{i}" for i in range(22)]
    items = [decontaminate.Item(0, decontaminate.of_text(ITEM), decontaminate.of_text(decontaminate.answer_of(ITEM)))]
    texts = [ITEM.encode(), " ".join([*many[:14], "x", *many[:1]]).encode(), " ".join(many[::-1]).encode()]
    part = c.Slice(texts, 0, 3)
    h, _ = decontaminate.word_hashes(part)
    count = np.bincount(decontaminate.bucket(h), minlength=decontaminate.BUCKETS).astype(float)
    used = np.unique(decontaminate.bucket(h))
    idf, row_of = np.zeros(decontaminate.BUCKETS), np.zeros(decontaminate.BUCKETS, np.int32)
    idf[used], row_of[used] = 1.0, np.arange(len(used))
    passages = np.full((1, len(used)), len(used) ** -0.5, np.float32)
    model = decontaminate.Model(items, idf, 1.0, row_of, np.eye(len(used), dtype=np.float32), passages, np.zeros(1, int), count)
    hashed, compared = [], []
    real_hashes, real_lcs = decontaminate.word_hashes, decontaminate.lcs
    monkeypatch.setattr(decontaminate, "word_hashes", lambda p: hashed.append(p) or real_hashes(p))
    monkeypatch.setattr(decontaminate, "lcs", lambda a, b: compared.append(len(b)) or real_lcs(a, b))
    assert {t: [m[0] for m in found] for t, found in decontaminate.look(model, part).items()} == {0: [0]}
    assert len(hashed) == 1
    assert min(compared) >= decontaminate.REWORDED * len(items[0].words)
