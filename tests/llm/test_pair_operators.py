"""Joins, deduplication, secrets, embeddings."""

import os
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from netfeat.llm import minhash, paragraphs, secrets
from netfeat.llm.caps import near_embeddings
from netfeat.llm.common import Workspace
from netfeat.llm.components import components, hub_join, hubs
from netfeat.llm.ngram_join import ngram_join, one_per_class


def rows_by_join(texts):
    """(class id, links) of each (id, text) row by brute force."""
    sets = [brute.shingles(t) for _, t in texts]
    links = brute.jaccard_links(sets)
    label = brute.classes(len(texts), links)
    n = [0] * len(texts)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    smallest = {}
    for (i, _), c in zip(texts, label):
        if i is not None:
            smallest[c] = min(i, smallest.get(c, i))
    return [(str(i), str(smallest.get(c)), k) for (i, _), c, k in zip(texts, label, n)]


# --- components


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1150)]
    edges += [(5000, 5000), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    ids = sorted({x for e in real for x in e})
    at = {x: k for k, x in enumerate(ids)}
    want = brute.classes(len(ids), [(at[a], at[b]) for a, b in real])
    assert got == {x: ids[c] for x, c in zip(ids, want)}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


# --- op3


def test_bands_reach_their_recall():
    for rows in (2, 3, 4, 5):
        b = minhash.choose_bands(0.8, 0.999, rows)
        assert 1 - (1 - 0.8**rows) ** b >= 0.999 > 1 - (1 - 0.8**rows) ** (b - 1)


def test_ngram_join_against_brute_force(spark, real):
    texts, df = real
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in ngram_join(df).collect())
    assert got == sorted(rows_by_join(texts))


def test_ngram_join_of_messy_rows(messy, messy_df, empty_df):
    texts = [(i, t) for i, t, *_ in messy]
    joined = ngram_join(messy_df)
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in joined.collect())
    want = []
    for (i, t), row in zip(texts, rows_by_join(texts)):
        want.append(row if brute.shingles(t) else (str(i), str(i), 0))
    assert got == sorted(want)
    kept = one_per_class(messy_df, joined)
    assert kept.columns == messy_df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if brute.shingles(r.text)) == sorted(
        [("1", texts[0][1]), ("7", "one two"), ("9", texts[11][1]), ("10", texts[12][1]), ("11", texts[13][1]), ("12", texts[14][1]), ("9", texts[15][1])]
    )
    assert ngram_join(empty_df).count() == 0


def test_ngram_join_across_blocks(spark, monkeypatch):
    """A group of near copies larger than a block: links and class as by brute force."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = []
    for k in range(50):
        w = list(base)
        w[rng.randrange(120)] = f"v{k % 30}"
        texts.append((k, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in ngram_join(df).collect()) == sorted(rows_by_join(texts))


@pytest.mark.parametrize("block", [2, 256])
def test_pairs_of_a_group_without_a_common_band_are_links(spark, monkeypatch, block):
    """Two items that share bands only with a third one are similar enough on their full sets."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    sets = [list(range(100)), list(range(1, 101)), list(range(2, 102))]
    rows = [(1, k, keys, bytearray(np.array(s, np.uint64).tobytes()), 1) for k, (keys, s) in enumerate(zip(([1, 2], [1, 3], [4, 3]), sets))]
    df = spark.createDataFrame(rows, "grp long, item long, keys array<long>, shingles binary, weight long")
    out = minhash.verified(df, Workspace(spark, "t"), "verify").collect()
    assert sorted((r.item, r.links) for r in out) == [(0, 2), (1, 2), (2, 2)] and len({r["class"] for r in out}) == 1


@pytest.mark.parametrize("tile", [3, 256])
def test_links_within_and_across_sides(monkeypatch, tile):
    """Counts and roots as by comparing all pairs, for sets of many sizes."""
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = random.Random(9)
    for n in (1, 2, 40):
        sets = []
        for _ in range(n):
            s = {rng.randrange(3) * 1000 + k for k in range(rng.choice([4, 20, 24, 30, 60]))}
            for _ in range(rng.randrange(5)):
                s.add(rng.randrange(10**6))
            sets.append(s)
        weight = np.array([rng.randrange(1, 4) for _ in sets])
        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        for side in (None, np.array([rng.random() < 0.5 for _ in sets])):
            if side is not None and (side.all() or not side.any()):
                continue
            links = [(a, b) for a, b in brute.jaccard_links(sets) if side is None or side[a] != side[b]]
            count = np.zeros(n, int)
            for a, b in links:
                count[a] += weight[b]
                count[b] += weight[a]
            got, root = minhash._link(arrays, weight, Fraction(4, 5), side)
            assert got.tolist() == count.tolist() and root.tolist() == brute.classes(n, links)


@pytest.mark.parametrize("n", [512, 2048, 8192])
def test_rows_of_a_group_grow_with_its_items(spark, n):
    """A group of near copies gives one row an item, however many pairs it has."""
    rows = [(1, k, [0], bytearray(np.sort(np.append(np.arange(40, dtype=np.uint64), np.uint64(1000 + k))).tobytes()), 1) for k in range(n)]
    df = spark.createDataFrame(rows, "grp long, item long, keys array<long>, shingles binary, weight long")
    work = Workspace(spark, "t")
    out = minhash.verified(df, work, "v").agg(F.count("*"), F.countDistinct("class"), F.min("links"), F.max("links")).first()
    assert tuple(out) == (n, 1, n - 1, n - 1)
    assert spark.read.parquet(f"{work.path}/v-links").count() == n


def test_hubs_are_bounded_and_their_rows_are_spread(spark):
    """A key of a third of all rows reaches many salts; the join's rows are those of a plain one."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("v"))
    table = rows.groupBy("k").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    found = hubs(table, "k", "n")
    assert found == [7] and hubs(table.where("k <> 7"), "k", "n") == []
    joined = hub_join(rows, "k", table.drop("n"), found)
    assert "salt" in joined._jdf.queryExecution().toString()
    assert sorted(map(tuple, joined.select("k", "v", "m").collect())) == sorted(map(tuple, rows.join(table.drop("n"), "k").select("k", "v", "m").collect()))


def test_components_with_a_hub(spark, monkeypatch):
    from netfeat.llm import components as module

    monkeypatch.setattr(module, "HUB_ROWS", 20)
    rng = random.Random(2)
    edges = [(500, k) for k in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark, "t")).collect()}
    ids = sorted({x for e in edges if e[0] != e[1] for x in e})
    at = {x: k for k, x in enumerate(ids)}
    want = brute.classes(len(ids), [(at[a], at[b]) for a, b in edges if a != b])
    assert got == {x: ids[c] for x, c in zip(ids, want)}


# --- op4


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(100_000)}" for _ in range(n)) + "."


def test_passages_inside_lines_and_whole_paragraphs(spark):
    rng = random.Random(6)
    passage = " ".join(sentence(rng, 12) for _ in range(5))
    paragraph = sentence(rng, 70)
    near = paragraph.replace(paragraph.split()[40], "changed")
    short = sentence(rng, 20)
    docs = [
        (1, f"{sentence(rng, 30)}\n{sentence(rng, 15)} {passage} {sentence(rng, 11)}\n{short}"),
        (2, f"{sentence(rng, 9)} {passage}\n{sentence(rng, 40)}\n{short}"),
        (3, f"{sentence(rng, 60)}\n{paragraph}\n{sentence(rng, 30)}"),
        (4, f"{near}\n{sentence(rng, 80)}"),
        (5, sentence(rng, 200)),
        (6, f"{passage}"),
    ]
    out = {r.doc_id: r for r in paragraphs.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    texts = dict(docs)
    for clean in (1, 3, 5):
        assert out[clean].text == texts[clean] and out[clean].removed_words == 0
    first, second, third = texts[2].split("\n")
    assert out[2].text == f"{first[: -len(passage)]}\n{second}\n{third}" and out[2].removed_words == 60
    assert out[4].text == texts[4].split("\n")[1]
    assert out[6].text == "" and out[6].removed_spans == f"0:{len(passage)}"
    for i, r in out.items():
        spans = [tuple(map(int, s.split(":"))) for s in r.removed_spans.split(",") if s]
        kept = texts[i]
        for a, b in reversed(spans):
            kept = kept[:a] + kept[b:]
        assert kept == r.text


def without_common_runs(texts, n=51):
    """The words of each text outside runs of ``n`` words that an earlier text holds."""
    seen, out = set(), []
    for text in texts:
        w = brute.WORD.findall(text.lower())
        grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        gone = {j for i, g in enumerate(grams) if g in seen for j in range(i, i + n)}
        out.append([x for j, x in enumerate(w) if j not in gone])
        seen.update(grams)
    return out


def test_passages_cut_inside_sentences_against_common_runs(spark):
    """Hosts that begin and end inside a passage's sentences; the first holder of a window need not hold the run."""
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(100_000)}" for _ in range(n)]
    source = [words(200) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = words(rng.randint(60, 90))
        for _ in range(rng.randint(0, 3)):
            passage, n = rng.choice(source), rng.choice([16, 30, 49, 50, 51, 52, 61, 90, 130])
            at = rng.randint(0, len(passage) - n)
            parts += passage[at : at + n] + words(rng.randint(25, 60))
        texts.append(" ".join(parts))
    passage = " ".join(f"{' '.join(words(13))}." for _ in range(4))
    texts += [f"{' '.join(words(90))} {passage} {' '.join(words(90))}", f"{' '.join(words(80))} {passage} {' '.join(words(80))}"]
    texts += [" ".join(["la"] * 300), "so " + " ".join(["la"] * 60) + " end", texts[3], ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = {r.doc_id: r for r in paragraphs.deduplicated(df).collect()}
    want = without_common_runs(texts)
    assert [brute.WORD.findall(out[k].text.lower()) for k in range(len(texts))] == want
    assert [out[k].removed_words for k in range(len(texts))] == [len(brute.WORD.findall(t)) - len(w) for t, w in zip(texts, want)]


def test_no_common_run_is_left(real):
    texts, df = real
    out = {r.doc_id: r for r in paragraphs.deduplicated(df).collect()}
    seen = set()
    for i, text in sorted(texts):
        spans = [tuple(map(int, s.split(":"))) for s in out[i].removed_spans.split(",") if s]
        found = [(m.group().lower(), any(a <= m.start() < b for a, b in spans)) for m in brute.WORD.finditer(text)]
        for k in range(len(found) - 50):
            if tuple(w for w, _ in found[k : k + 51]) in seen:
                assert all(gone for _, gone in found[k : k + 51]), i
        w = [w for w, _ in found]
        seen.update(tuple(w[k : k + 51]) for k in range(len(w) - 50))


def check_passages(rows, out):
    """``rows`` (id, text) against ``out`` (id, text, removed_spans, removed_words), by definition."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    want = brute.without_passages([t for _, t in order])
    got = {r.doc_id: (r.text, r.removed_spans, r.removed_words) for r in out}
    assert len(got) == len(rows)
    for (i, _), (text, spans, gone) in zip(order, want):
        assert got[i] == (text, ",".join(f"{a}:{b}" for a, b in spans), gone), i


def test_passages_by_definition(real):
    texts, df = real
    check_passages(texts, paragraphs.deduplicated(df).collect())


def test_passages_by_definition_on_more_documents(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables not present")
    df = spark.read.parquet(path)
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    check_passages(texts, paragraphs.deduplicated(df).collect())


def test_case_outside_ascii_and_changing_lengths(spark):
    """Upper and lower case are one word in all alphabets, also where a character's length changes; offsets are those of the text."""
    rng = random.Random(14)
    letters = ["é", "ß", "ж", "ω", "ñ", "ü", "z", "k", "i\u0307"]
    low = ["".join(rng.choice(letters) for _ in range(6)) + str(k) for k in range(70)]
    high = [w.replace("i\u0307", "İ").replace("k", "\u212a").replace("é", "É").replace("ж", "Ж").replace("ω", "Ω").replace("ñ", "Ñ").replace("ü", "Ü") for w in low]
    assert [w.lower() for w in high] == low and any(len(a.encode()) != len(b.encode()) for a, b in zip(low, high))
    rows = [(1, "İ before " + " ".join(low)), (2, "Ⱥ " + " ".join(high) + " İ after"), (3, "nothing in common")]
    out = paragraphs.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_passages(rows, out)
    assert {r.doc_id: r.removed_words for r in out} == {1: 0, 2: 73, 3: 0}  # the whole line is a near copy


def test_no_long_passage_is_left_twice(real):
    _, df = real
    out = paragraphs.deduplicated(df).collect()
    owner = {}
    for r in out:
        for line in r.text.split("\n"):
            if len(brute.WORD.findall(line)) >= 50:
                key = tuple(brute.WORD.findall(line.lower()))
                assert owner.setdefault(key, r.doc_id) == r.doc_id


def test_paragraphs_of_messy_rows(messy, messy_df, empty_df):
    out = paragraphs.deduplicated(messy_df, keep=messy_df.columns).collect()
    assert len(out) == len(messy)
    assert {r.text for r in out if r.doc_id in (4, 5, 6)} == {None, "", " \n\t "}
    assert paragraphs.deduplicated(empty_df).count() == 0


def test_repeated_rows_ties_and_null_ids(spark):
    """Equal rows are one document; of two texts under one id one keeps the passage; a null id comes last."""
    rng = random.Random(15)
    passage = " ".join(sentence(rng, 12) for _ in range(5))
    own = [sentence(rng, 30) for _ in range(4)]
    rows = [(5, f"{own[0]}\n{passage}"), (5, f"{own[0]}\n{passage}"), (5, f"{own[1]}\n{passage}"), (None, f"{own[2]}\n{passage}"), (2**62, f"{own[3]}\n{passage}")]
    out = paragraphs.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = sorted((str(r.doc_id), r.text.split("\n")[0], passage in r.text) for r in out)
    assert [k for i, t, k in kept if i != "5"] == [False, False]
    same = [k for i, t, k in kept if t == own[0]]
    assert len(same) == 2 and same[0] == same[1]
    assert [k for i, t, k in kept if t == own[1]] == [not same[0]]


# --- op5


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(secrets, "_BLOCK", 4)
    data = [([],), ([3],), (list(range(1, 22)),)]
    df = spark.createDataFrame(data, "a array<bigint>").select(secrets.running(F.col("a")).alias("s"))
    for (a,), r in zip(data, df.collect()):
        assert r.s == [sum(a[:k]) for k in range(len(a))]


PATTERNS = ((secrets.ASSIGN, 2), (secrets.ACCESS, 0), (secrets.HEX, 0))


def base_of(text):
    return brute.secret_spans(text, PATTERNS, list(secrets.LEAST.values()))


def test_base_spans_against_brute_force(spark, real, messy, messy_df, empty_df):
    texts, df = real
    for rows, table in ((texts, df), ([(i, t) for i, t, *_ in messy], messy_df)):
        got = sorted((str(r.doc_id), [(s.start, s.kind, s.end) for s in r.base]) for r in secrets.secret_spans(table).collect())
        assert got == sorted((str(i), base_of(t)) for i, t in rows)
    assert secrets.secret_spans(empty_df).count() == 0


def test_base_spans_of_odd_texts(spark):
    rng = random.Random(8)
    parts = ["password", "PASSWD", "api_key", "apikey", "token", "secret", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGHIJKLMN", "0123456789abcdef", "deadbeef", "é", "\n", "x.y-z/+_=", "Q"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.base] for r in secrets.secret_spans(df).collect()}
    assert got == {i: base_of(t) for i, t in enumerate(texts)}


def test_owned_runs_become_spans_and_copied_ones_do_not(spark):
    own, example = "Zk3pQ9rT7wXa2LmN8vBc4", "EXAMPLEkey00aaBBcc11ddEE"
    rows = [(1, f"live {own} here", "a"), (2, f"copy {example}", "a"), (3, f"copy {example}", "b"), (4, f"copy {example}", "c"), (5, f"again {own}", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spans = secrets.secret_spans(df)
    got = {r.doc_id: r.spans for r in secrets.digests(spans).collect()}
    assert got == {1: f"owned:5:{5 + len(own)}", 2: "", 3: "", 4: "", 5: f"owned:6:{6 + len(own)}"}
    clean = {r.doc_id: r.text for r in secrets.redacted(df, spans).collect()}
    assert clean == {1: "live [SECRET] here", 2: f"copy {example}", 3: f"copy {example}", 4: f"copy {example}", 5: "again [SECRET]"}


def test_a_value_of_one_owner_in_many_repositories_is_copied(spark):
    """A key that one source repeats in ten repositories is boilerplate; in nine it is still the owner's."""
    often, seldom = "Zk3pQ9rT7wXa2LmN8vBc4", "Ak3pQ9rT7wXa2LmN8vBc9"
    rows = [(k, f"key {often}" + (f" and {seldom}" if k < 9 else ""), "a") for k in range(10)] + [(k, f"key {often}", "a") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.spans) for r in secrets.digests(secrets.secret_spans(df)).collect()]
    at = 4 + len(often) + 5
    assert sorted(got) == sorted((i, f"owned:{at}:{at + len(seldom)}" if seldom in t else "") for i, t, _ in rows)


def test_secrets_plan_has_no_python(messy_df):
    plan = secrets.digests(secrets.secret_spans(messy_df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- op8


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 64))
    rows = []
    for k in range(300):
        v = centre[k % 6] + rng.standard_normal(64) * (0.25 if k % 2 else 1.5)
        rows.append((k, [float(x) for x in np.float32(v)], k % 3 if k % 7 else None))
    rows += [(300 + k, rows[5][1], rows[5][2]) for k in range(9)]
    rows += [(400, None, 1), (401, [0.0] * 64, 1), (402, [float("nan")] * 64, 1), (403, [None] * 64, 1), (404, [1.0, 2.0], 1), (405, [2.0, 4.0], 1), (None, rows[5][1], rows[5][2]), (406, [], 1), (407, [float("inf")] * 64, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("item", F.lit("x"))
    good = [k for k, (i, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = set()
    for a in good:
        for b in good:
            u, v = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and rows[a][2] == rows[b][2] and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                links.add((a, b))
    label, n = brute.classes(len(rows), links), [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    smallest = {}
    for (i, *_), c in zip(rows, label):
        if i is not None:
            smallest[c] = min(i, smallest.get(c, i))
    want = sorted((str(i), k, str(smallest.get(c))) for (i, *_), c, k in zip(rows, label, n))
    got = near_embeddings(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert near_embeddings(df.limit(0)).count() == 0


def test_embeddings_find_planted_pairs(spark):
    """1,500 pairs of cosine 0.930001 to 0.95, the hardest to find, and 500 of 0.91 to 0.929, all of one label."""
    rng = np.random.default_rng(11)
    cosines = np.concatenate((rng.uniform(0.930001, 0.95, 1500), rng.uniform(0.91, 0.929, 500)))
    rows = []
    for k, c in enumerate(cosines.tolist()):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), 1)]
    out = {r.vec_id: r for r in near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    found = [k for k in range(len(cosines)) if out[2 * k + 1].component_id == 2 * k]
    assert all(k < 1500 for k in found)
    assert len(found) >= 0.99 * 1500
