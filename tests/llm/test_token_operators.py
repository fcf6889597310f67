"""Cross-tokenizer alignment, Arrow sequences, source audit."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

import brute
from netfeat.llm import alignment, sequences, sources_audit, tokens
from netfeat.llm.common import Workspace
from netfeat.llm.queries import vocabulary

A, B, IDS = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")

# --- op11


@pytest.fixture(scope="module")
def token_bytes():
    """(tokenizer A, its bytes by id, tokenizer B, its bytes by id), each from its own library."""
    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = {c: k for k, c in enumerate(bytes_to_characters())}
    # UTF-8 never holds the others, which are tokens all the same
    of_a = {i: bytes(alphabet[c] for c in t) for t, i in a.get_vocab().items() if all(c in alphabet for c in t)}
    assert len(of_a) == a.get_vocab_size() - 13
    of_b = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        of_b[i] = bytes.fromhex(p[3:5]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    return a, of_a, b, of_b


def bytes_to_characters():
    """The printed character of each byte, by encoding it alone."""
    pre = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    out = [None] * 256
    for code in [*range(0x80), *range(0x80, 0x800), 0x800, 0xFFFF, *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)]:
        if 0xD800 <= code < 0xE000:
            continue
        for byte, c in zip(chr(code).encode(), pre.pre_tokenize_str(chr(code))[0][0]):
            out[byte] = c
    return out


def align_all(texts, tokens):
    """Rows by brute force: every pair of tokens is compared."""
    a, of_a, b, of_b = tokens
    done = []
    for t in texts:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        want = b" " + (t or "").encode()
        if not t or b"".join(of_a[i] for i in x) != want or b"".join(of_b[i] for i in y) != want:
            done.append(([], [], [], []))
            continue
        spans = []
        for ids, of in ((x, of_a), (y, of_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(of[i])))
                at += len(of[i])
            spans.append(out)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, lo = [], 0
        for hi in ends:
            groups.append(tuple([i for i, (s, e) in zip(ids, sp) if lo <= s and e <= hi] for ids, sp in ((x, spans[0]), (y, spans[1]))))
            lo = hi
        links = [(i, j) for i, (s, e) in zip(x, spans[0]) for j, (u, v) in zip(y, spans[1]) if s < v and u < e]
        done.append((x, y, groups, links))
    count = Counter(p for *_, links in done for p in set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for x, y, groups, links in done:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((
            len(x), len(y), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


MIXED = [
    "The quick brown fox", "der schnelle Fuchs über", "naïve café 日本語 🙂", "<|endoftext|> and </s> <s> <0x41>", "▁ odd", "two  blanks\n\ttab\r\n",
    " lead", "trail ", "", None, "aaaaaaaaaaaaaaaa", "1234567890 12", "ﬁ ligature ① ½", "The quick brown fox", "xa aax aaxx", "\x00 \x7f", "É" * 50,
]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 40, "part_bytes": 64, "lane_blocks": 2}])
def test_alignment_against_brute_force(spark, token_bytes, options):
    rng = random.Random(3)
    words = ["the", "cat", "über", "日本", "running", "x1", "ab\n", "fi🙂", "don't", "...", "Straße"]
    texts = MIXED + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(30)] + ["cat " * 700]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.alignment(df, A, B, **options).collect()}
    assert [got[k] for k in range(len(texts))] == align_all(texts, token_bytes)


def test_identities_and_their_pairs_meet_in_one_count(token_bytes):
    """A pair of the same bytes is one pair wherever it is linked, and the map holds all that have a partner."""
    _, of_a, _, of_b = token_bytes
    v = alignment.vocabularies(A, B)
    back = defaultdict(set)
    for i, raw in of_b.items():
        back[raw].add(i)
    for i, raw in of_a.items():
        assert v.bytes_a[i] == raw
        assert (int(v.same[i]) in back[raw]) if raw in back else v.same[i] == -1
    assert v.bytes_b == [of_b[i] for i in range(len(of_b))]


def test_alignment_of_messy_rows(messy, messy_df, empty_df, token_bytes):
    want = sorted((str(i), *row) for (i, *_), row in zip(messy, align_short([t for _, t, *_ in messy], token_bytes)))
    got = sorted((str(r.doc_id), *tuple(r)[1:4]) for r in alignment.alignment(messy_df, A, B).collect())
    assert got == want
    assert alignment.alignment(empty_df, A, B).count() == 0


def align_short(texts, tokens):
    """(n_a, n_b, n_groups) also of very long texts."""
    a, of_a, b, of_b = tokens
    out = []
    for t in texts:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        want = b" " + (t or "").encode()
        if not t or b"".join(of_a[i] for i in x) != want or b"".join(of_b[i] for i in y) != want:
            out.append((0, 0, 0))
            continue
        ends = [set(np.cumsum([len(of[i]) for i in ids]).tolist()) for ids, of in ((x, of_a), (y, of_b))]
        out.append((len(x), len(y), len(ends[0] & ends[1])))
    return out


# --- op12


def ids_by_library(texts):
    t = tokenizers.Tokenizer.from_file(IDS)
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check_sequences(got, rows):
    """``rows`` (id, text): each document's place and checksum in the order of ids, null last; rows of one id in any order."""
    ids = ids_by_library([t for _, t in rows])
    want = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(rows, ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is None, i))


@pytest.mark.parametrize("memo", [5, 1_000])
def test_ids_of_pieces_are_the_library_s(memo):
    """Marks that a letter's lower case or normal form ends with belong to the punctuation after it."""
    texts = ["İ, İ. \u0958! a", "Word, word (word) don't 's. it's' a_b x--", "", "  \n\t", "ΣΑΣ, ß! é? <|endoftext|>", "WORD word,, Word.", "y" * 100]
    tokenizer = tokens.Tokenizer(IDS, memo)
    for _ in range(2):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in tokenizer.encode(texts)]
        assert got == [ids[:-1] for ids in ids_by_library(texts)]
    assert tokenizer.encode([]) == []


@pytest.mark.parametrize("options", [{}, {"length": 16, "batch": 3, "shard_tokens": 500, "task_bytes": 4000}])
def test_sequences_of_messy_rows(messy, messy_df, empty_df, options):
    check_sequences(sequences.token_sequences(messy_df, IDS, **options).collect(), [(i, t) for i, t, *_ in messy])
    assert sequences.token_sequences(empty_df, IDS, **options).count() == 0


def test_sequences_of_the_table(spark, real):
    texts, df = real
    check_sequences(sequences.token_sequences(df, IDS, shard_tokens=20_000).collect(), texts)


def test_shards_are_read_at_random_without_copies(spark):
    """Each sequence and mask is a view of the mapped file; together they are the ids and the padding."""
    texts = [f"some words {k} " * (k % 40) for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    work = Workspace(spark, "t")
    manifest = sequences.write_sequences(df, IDS, work, length=32, batch=4, shard_tokens=1000).orderBy("part", "shard").collect()
    assert len(manifest) > 2 and all(m.n_tokens < 1000 + max(map(len, ids_by_library(texts))) for m in manifest)
    every, seen = [], []
    for m in manifest:
        shard = sequences.Shard(*(f"{work.path}/shards/{f}" for f in (m.sequences_file, m.index_file)))
        assert len(shard) == m.n_sequences == -(-m.n_tokens // 32)
        for k in reversed(range(len(shard))):
            ids, mask = shard.sequence(k)
            assert len(ids) == 8 * len(mask) == 32 and ids.dtype == np.uint16
            assert not any(x.flags.owndata or x.flags.writeable for x in (ids, mask))
            mask = sequences.unpacked(mask)
            assert mask.sum() == min(32, m.n_tokens - 32 * k) and not ids[mask == 0].any() and (np.diff(mask.astype(int)) <= 0).all()
        buffer = pa.memory_map(f"{work.path.removeprefix('file:')}/shards/{m.sequences_file}").read_buffer()
        assert ids.tobytes() in buffer.to_pybytes()
        allocated = pa.total_allocated_bytes()
        assert all(shard.sequence(k)[0] is not None for k in range(len(shard))) and pa.total_allocated_bytes() == allocated
        flat = np.concatenate([i[sequences.unpacked(mk) == 1] for i, mk in map(shard.sequence, range(len(shard)))]) if len(shard) else []
        every += list(flat)
        for batch in shard.documents():
            for i, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                seen.append(i)
                assert list(np.concatenate(list(shard.tokens(start, n)))) == ids_by_library([texts[i]])[0]
        shard.close()
    assert every == sum(ids_by_library(texts), []) and seen == list(range(60))


def test_rows_of_one_id_are_dealt_to_several_shards(spark):
    rows = [(None if k % 3 == 0 else k, "a few words here") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    work = Workspace(spark, "t")
    manifest = sequences.write_sequences(df, IDS, work).collect()
    most = max(m.n_documents for m in manifest)
    assert most <= 2 * 3000 / len(manifest) and len(manifest) >= 8
    check_sequences(sequences.read_documents(spark.createDataFrame(manifest), work).collect(), rows)


# --- op13

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit(rows, least=30, top=50):
    """``rows`` (lang, source, text)."""
    lower = {c: c + 32 for c in range(65, 91)}
    words = [(g or "", s or "", TERM.findall((t or "").translate(lower))) for g, s, t in rows]
    documents, count, whole = Counter(), Counter(), Counter()
    for g, s, w in words:
        documents.update((g, t) for t in set(w))
        count.update((g, s, t) for t in w)
        whole.update((g, t) for t in w)
    out = []
    for lang in {g for g, *_ in words}:
        kept = [t for (g, t), n in documents.items() if g == lang and n >= least]
        sources = {s for g, s, _ in words if g == lang}
        n = {s: sum(count[lang, s, t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (count[lang, s, t] + 5) // (n[s] + 5 * len(kept)) for t in kept} for s in sources}
        total = sum(whole[lang, t] for t in kept)
        q = {t: 1 + 10**9 * (whole[lang, t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items)]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


@pytest.mark.parametrize("block, unit, shard", [(128, 20_000, 8 << 20), (2, 3, 200)])
def test_audit_against_brute_force(spark, monkeypatch, block, unit, shard):
    monkeypatch.setattr(sources_audit, "BLOCK", block)
    monkeypatch.setattr(sources_audit, "TERMS_PER_UNIT", unit)
    monkeypatch.setattr(sources_audit, "SHARD_BYTES", shard)
    rng = random.Random(8)
    words = ["the", "The", "über", "ÜBER", "eightchr", "eightchrs", "eightchrsixteenc", "eightchrsixteencx", "a", "日本語", "x y", "É", "z9z", "no-", "K"]
    rows = []
    for _ in range(260):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 9)))
        rows.append((rng.choice(["en", "de", None]), rng.choice(["web", "news", "", None, "bücher", "z"]), text if rng.random() < 0.95 else None))
    rows += [("xx", "alone", "only here"), ("yy", "one", ""), ("yy", "two", None), ("en", "wordless", "... 123")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert rows_of(sources_audit.divergence(df, min_documents=6, top=3)) == audit(rows, 6, 3)


def test_audit_of_messy_rows(messy, messy_df, empty_df):
    rows = [(r[2], r[3], r[1]) for r in messy]
    assert rows_of(sources_audit.divergence(messy_df, min_documents=2)) == audit(rows, 2)
    assert sources_audit.divergence(empty_df).count() == 0


def test_pointers_are_sorted_like_the_words():
    rng = random.Random(5)
    for n in (0, 1, 2, 400):
        texts = [" ".join("".join(rng.choices("abÄz", k=rng.choice([1, 2, 7, 8, 9, 16, 17, 24]))) for _ in range(rng.randrange(12))) for _ in range(n)]
        texts += ["same" * 5] * (n > 1)
        array = pa.array(["skipped", *texts, None]).slice(1)
        data, offsets = sources_audit.text_buffer(array)
        start, end, text = sources_audit.word_pointers(data, offsets)
        want = [(w.encode(), k) for k, t in enumerate(texts) for w in TERM.findall(t)]
        assert [(data[s:e].tobytes(), k) for s, e, k in zip(start, end, text)] == want
        order, first = sources_audit.sort_pointers(data, start, end)
        got = [want[k] for k in order]
        assert got == sorted(want) and [w for w, _ in (got[k] for k in first)] == sorted({w for w, _ in want})


def test_smoothed_probabilities_are_exact(spark):
    from pyspark.sql import functions as F

    rows = [(0, 0, 1), (5, 7, 3), (10**12, 3 * 10**12, 10**6), (4 * 10**15, 5 * 10**15, 10**9), (1, 10**15, 1)]
    out = spark.createDataFrame(rows, "c long, n long, v long")
    got = [r[0] for r in out.select(sources_audit.smoothed(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in rows]
