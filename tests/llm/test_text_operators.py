"""Per-document operators: quality, rules, toxicity, tokens, packing, scores."""

import base64
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from netfeat.llm import backoff, boosting, bpe, kernel, packing, quality, toxicity
from netfeat.llm.divergence import distance, quality_rules
from netfeat.llm.queries import QUERIES, vocabulary

WORDS = vocabulary("word_bpe_49k.json")
RANKS = vocabulary("byte_bpe_multi_50k.tiktoken")


def pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


# --- kernel


def test_words_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab \n.é") for _ in range(rng.randint(0, 400))) for _ in range(50)] + ["z" * 999, ""]
    whole = kernel.words(texts, kernel.PUNCTUATION)
    monkeypatch.setattr(kernel, "_SLICE", 64)
    monkeypatch.setattr(kernel, "_POW", [])
    cut = kernel.words(texts, kernel.PUNCTUATION)
    assert (whole.hash == cut.hash).all() and (whole.start == cut.start).all() and (whole.end == cut.end).all()
    raw = whole.buffer.tobytes()
    by_word = {}
    for h, s, e in zip(whole.hash.tolist(), whole.start, whole.end):
        assert by_word.setdefault(h, raw[s:e]) == raw[s:e]
    assert len(by_word) == len(set(by_word.values()))


# --- op1


def test_trees_are_traversed_as_they_were_grown():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > -0.2)).astype(float)
    t = boosting.fit(x, y)
    assert ((t.probability(x) >= 0.5) == y).mean() > 0.97

    def walk(row):
        total = t.base
        for root in t.roots:
            k = root
            while t.feature[k] >= 0:
                k = t.child[k] + (row[t.feature[k]] > t.threshold[k])
            total += t.value[k]
        return total

    assert np.allclose([walk(r) for r in x[:50]], t.raw(x[:50]))


def test_quality_on_the_held_out_fold(spark, sf):
    rows = QUERIES["op1_quality"](spark, sf.replace("sf0.001", "sf0.01")).toPandas()
    labels = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/labels.parquet").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(rows.doc_id, rows.held_out))
    held = rows.merge(labels, on="doc_id").query("held_out")
    assert (held.predicted == held.quality).mean() > 0.97
    assert ((rows.score >= 0.5).astype(int) == rows.predicted).all() and rows.score.between(0, 1).all()


def test_quality_and_toxicity_of_messy_rows(spark, messy, messy_df, empty_df):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (1, 1, 0), (7, None, None), (8, 0, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for train, apply in ((quality.train, quality.quality), (toxicity.train, toxicity.toxicity)):
        for model in (train(messy_df, labels), train(empty_df, labels), train(messy_df, labels.limit(0))):
            out = apply(messy_df, model).toPandas()
            assert len(out) == len(messy) and out.score.between(0, 1).all()
            assert apply(empty_df, model).count() == 0
    clean = toxicity.keep_clean(messy_df, toxicity.train(messy_df, labels.limit(0)))
    assert clean.columns == messy_df.columns and clean.count() == len(messy)


# --- op2


def test_rules_against_brute_force(spark, real):
    texts, df = real
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules(df).collect()}
    assert got == {i: brute.base_rules(t) for i, t in texts}


def test_rules_of_messy_rows(spark, messy, messy_df, empty_df):
    rows = quality_rules(messy_df).collect()
    got = sorted((str(r.doc_id), *tuple(r)[1:7]) for r in rows)
    assert got == sorted((str(i), *brute.base_rules(t)) for i, t, *_ in messy)
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality_rules(empty_df).count() == 0


def test_rules_reject_what_diverges(spark):
    plain = ["the road went to the hills and the people of the town were in it for the day that was long " * 3 + f"end{k}x" for k in range(20)]
    plain = [" ".join(random.Random(k).sample(p.split(), len(p.split()))) for k, p in enumerate(plain)]
    odd = " ".join(f"{k}%$#|{k * 7}" for k in range(100))
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate([*plain, odd])], "doc_id long, text string, lang string")
    out = {r.doc_id: r.kept for r in quality_rules(df).collect()}
    assert not out[20] and all(out[k] for k in range(20))


def test_distance_is_a_jensen_shannon_distance():
    p, q = np.array([[1.0, 0.0], [0.5, 0.5]]), np.array([0.0, 1.0])
    assert distance(p, q)[0] == pytest.approx(1) and distance(p, p[1])[1] == pytest.approx(0, abs=1e-6)


# --- op6


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(5)
    syllables = ["ba", "ko", "ri", "tu", "men", "sal", "vo", "li"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(600):
        text = [word() for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                text[rng.randrange(60)] = rng.choice(["zgrumpf", "qwaddel", "xyrrk"])
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.toxicity(d, toxicity.train(d, lab)).toPandas().merge(lab.toPandas(), on="doc_id").query("held_out")
    assert (out.predicted == out.toxic).mean() > 0.97


def test_a_worker_holds_one_large_state():
    """Calibration and scoring share the windows' savings, and a state of another kind replaces them."""
    from netfeat.llm.common import one_for_worker

    fit, final = (toxicity.Model(b"ordinary words", b"zgrumpf", w) for w in ((0.0, 0.0, 0.0), (-3.0, 9.0, 2.0)))
    scorer = toxicity._scorer(fit)
    assert toxicity._scorer(final) is scorer
    texts = ["zgrumpf on the road", ""]
    assert toxicity._scorer(final).scores(texts, final.weights).tolist() == toxicity.Scorer(final).scores(texts).tolist()
    other = one_for_worker(lambda k: [k])
    assert other(1) is other(1)
    assert toxicity._scorer(final) is not scorer


def test_toxicity_learns_from_whole_texts(spark):
    """The words that tell stand behind the first 1,500 words of each toxic document."""
    rng = random.Random(7)
    syllables = ["ba", "ko", "ri", "tu", "men", "sal", "vo", "li"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(240):
        text = [word() for _ in range(1600)]
        if i % 4 == 0:
            for at in rng.sample(range(1500, 1600), 2):
                text[at] = rng.choice(["zgrumpf", "qwaddel", "xyrrk"])
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(d, lab)
    assert all(toxicity.window_bytes(x) in model.toxic for x in ("zgrumpf", "qwaddel", "xyrrk"))
    out = toxicity.toxicity(d, model).toPandas().merge(lab.toPandas(), on="doc_id").query("held_out")
    assert (out.predicted == out.toxic).mean() > 0.97


# --- op7


def test_bpe_equals_the_public_library(spark, real):
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
    texts, df = real
    own = bpe.encoding(RANKS, pattern())
    rng = random.Random(1)
    odd = ["".join(rng.choice("ab \n\tzé'’sS1２ ̈　\x85\x1c#$-日本") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    odd += ["a" * 20_000, "ab" * 10_000 + "c", " " * 5000 + "x", "é日" * 8000, "".join(rng.choice("abcd") for _ in range(30_000))]
    for t, ids in zip(odd, own.encode(odd)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert own.decode(ids) == t.encode()
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(df, RANKS, pattern()).collect()}
    for i, t in texts:
        ids = library.encode_ordinary(t)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_bpe_of_messy_rows(messy, messy_df, empty_df):
    out = bpe.encoded(messy_df, RANKS, pattern()).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in out) == sorted((str(i), (t or "").encode()) for i, t, *_ in messy)
    assert bpe.encoded(empty_df, RANKS, pattern()).count() == 0


def test_a_lower_pair_that_a_merge_makes_comes_first():
    """Ranks in which merging "ab" makes the lower pair "ab" + "c"."""
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 9, b"abc": 3, b"ca": 20}
    e = bpe.Encoding(ranks, r"\S+")
    assert np.frombuffer(e.merge([b"abcabab"])[0], "<u4").tolist() == [3, 9, 9]


# --- op9


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return [e.ids + [0] for e in t.encode_batch(texts, add_special_tokens=False)]


def check_packing(rows, texts):
    """Every document whole and in order, no sequence too long, no gap."""
    want = sorted((str(i), ids) for (i, _), ids in zip(texts, ids_of([t or "" for _, t in texts])))
    expected = sorted(
        (i, k, lo, len(ids[lo : lo + 2048]), zlib.crc32(np.array(ids[lo : lo + 2048], "<u4").tobytes()))
        for i, ids in want
        for k, lo in enumerate(range(0, len(ids), 2048))
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by)


def test_packing_is_exact_and_tight(spark, real):
    texts, df = real
    n = check_packing(packing.packed(df, WORDS).collect(), texts)
    total = sum(map(len, ids_of([t for _, t in texts])))
    assert n <= math.ceil(total / 2048) + 2


def test_packing_of_messy_rows(messy, messy_df, empty_df):
    check_packing(packing.packed(messy_df, WORDS).collect(), [(i, t) for i, t, *_ in messy])
    assert packing.packed(empty_df, WORDS).count() == 0


def test_swaps_empty_bins_that_best_fit_leaves():
    size = [6, 6, 5, 5, 4, 4, 3, 3, 2, 2]  # best fit needs no help here, a bad start does
    bad = [[0, 4], [1], [2, 6], [3], [5, 7], [8, 9]]
    better = packing.improve([list(b) for b in bad], size, 10)
    assert sorted(i for b in better for i in b) == list(range(10))
    assert all(sum(size[i] for i in b) <= 10 for b in better) and len(better) < len(bad)
    rng = random.Random(2)
    for _ in range(20):
        size = [rng.randint(1, 2048) for _ in range(300)]
        bins = packing.pack(size)
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert max(sum(size[i] for i in b) for b in bins) <= 2048


def steps(bins, size, capacity):
    """The gains in squared fill of all moves and exchanges of one or two against at most two between underfull bins."""
    fill = [sum(size[i] for i in b) for b in bins]
    parts = [{n: [sum(c) for c in itertools.combinations([size[i] for i in b], n)] for n in (0, 1, 2)} for b in bins]
    for s, t in itertools.permutations([b for b in range(len(bins)) if fill[b] < capacity], 2):
        for n, k in ((1, 0), (1, 1), (1, 2), (2, 1)):
            for out, back in itertools.product(parts[s][n], parts[t][k]):
                gain = out - back
                if 0 < gain <= capacity - fill[t]:
                    yield (fill[t] + gain) ** 2 + (fill[s] - gain) ** 2 - fill[t] ** 2 - fill[s] ** 2


def test_the_search_ends_where_no_step_helps():
    rng = random.Random(4)
    ended = 0
    for _ in range(60):
        size = [rng.randint(8, 40) for _ in range(rng.randint(1, 40))]
        bins = packing.pack(size, 60)
        assert sorted(i for b in bins for i in b) == list(range(len(size)))
        if len(bins) > -(-sum(size) // 60):
            ended += 1
            assert max(steps(bins, size, 60), default=0) <= 0
    assert ended > 10


@pytest.mark.parametrize(("low", "high", "bins"), [(600, 1099, 271), (400, 1399, 268)])
def test_every_underfull_bin_is_searched(low, high, bins):
    rng = random.Random(1)
    assert len(packing.pack([rng.randint(low, high) for _ in range(600)])) <= bins


def test_equal_rows_are_dealt_to_all_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 60)
    texts = [(None, "one and the same") if i % 3 == 0 else (i, f"text {i} of many") for i in range(900)]
    rows = packing.packed(spark.createDataFrame(texts, "doc_id long, text string"), WORDS).collect()
    check_packing(rows, texts)
    shards = Counter(r.sequence_id % 15 for r in rows)
    assert len(shards) == 15 and max(shards.values()) <= 2 * 60


# --- op10


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_against_brute_force(real, order, monkeypatch):
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(backoff, "PART_ENTRIES", 5_000)
    texts, df = real
    want = dict(zip([i for i, _ in texts], brute.backoff([t for _, t in texts], order, 0.4)))
    for r in backoff.scores(df, order=order).collect():
        n, backed, score = want[r.doc_id]
        assert (r.n_words, r.n_backoff) == (n, backed) and r.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_backoff_of_messy_rows(messy, messy_df, empty_df):
    want = sorted((str(i), n, b, round(s, 6)) for (i, *_), (n, b, s) in zip(messy, brute.backoff([m[1] for m in messy], 2, 0.4)))
    got = sorted((str(r.doc_id), r.n_words, r.n_backoff, round(r.score, 6)) for r in backoff.scores(messy_df).collect())
    assert got == want
    assert backoff.scores(empty_df).count() == 0


def test_backoff_of_many_equal_rows(spark, monkeypatch):
    """A third of the rows are one row, a third hold no text; the copies are each other's other rows."""
    monkeypatch.setattr(backoff, "BLOCK_BYTES", 500)
    monkeypatch.setattr(backoff, "PART_ENTRIES", 50)
    monkeypatch.setattr(backoff, "_LOT", 7)
    rows = [[(None, "one and the same row"), (None, ""), (i, f"row {i} of the many rows")][i % 3] for i in range(240)]
    want = sorted((str(i), n, b, round(s, 6)) for (i, _), (n, b, s) in zip(rows, brute.backoff([t for _, t in rows], 3, 0.4)))
    out = backoff.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), order=3)
    assert sorted((str(r.doc_id), r.n_words, r.n_backoff, round(r.score, 6)) for r in out.collect()) == want
    assert [r.n_words for r in backoff.scores(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()] == [0, 0]
