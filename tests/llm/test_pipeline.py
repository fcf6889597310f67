"""The pipeline's rows against a brute-force version of its stages."""

import corpus_pipeline
import brute
from netfeat.llm import secrets, toxicity
from test_pair_operators import rows_by_join
from test_text_operators import check_packing


def reference(spark, df, sf):
    """Texts that reach the last stage. The model is the stage's own; all else is plain Python."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scorer = toxicity.Scorer(toxicity.train(df, labels))
    rows = sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    rows = [r for r in rows if scorer.scores([r[1] or ""])[0] < 0.7]
    joined = rows_by_join(rows)
    rows = [r for r, (i, c, _) in zip(rows, joined) if i == c or not brute.shingles(r[1])]
    done = []
    for (i, _), (text, _, gone) in zip(rows, brute.without_passages([t for _, t in rows])):
        if gone and not text.strip():
            continue
        at, parts = 0, []
        for start, _, end in brute.secret_spans(text, ((secrets.ASSIGN, 2), (secrets.ACCESS, 0), (secrets.HEX, 0)), list(secrets.LEAST.values())):
            if start >= at:
                parts += [text[at:start], secrets.REDACTED]
            at = max(at, end)
        done.append((i, "".join([*parts, text[at:]])))
    return done


def test_pipeline_against_brute_force(spark, sf, real):
    _, df = real
    want = reference(spark, df, sf)
    check_packing(corpus_pipeline.run(spark, sf).collect(), want)


def test_paragraphs_stage_leaves_no_common_run(spark, sf, real):
    """No run of 51 words of a document that leaves the stage is in an earlier document that entered it."""
    docs = real[1]
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, sf)
    entered = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    left = {r.doc_id: r.text for r in corpus_pipeline.STAGES[2][1](spark, docs, sf).select("doc_id", "text").collect()}
    runs = lambda w: {tuple(w[k : k + 51]) for k in range(len(w) - 50)}
    seen = set()
    for i in sorted(entered):
        assert not seen & runs(brute.WORD.findall(left.get(i, "").lower())), i
        seen |= runs(brute.WORD.findall(entered[i].lower()))


def test_stages_keep_the_columns(spark, sf, messy_df, empty_df):
    for docs in (messy_df, empty_df):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            assert docs.isEmpty() == out.isEmpty(), name
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).isEmpty() == docs.isEmpty()


def test_the_other_queries_stand_without_this_part():
    import __spark_entry__ as entry

    assert not any(k.startswith("op") and k[2:3].isdigit() for k in entry.QUERIES)
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {k if k == "pipeline" else k.split("_")[0] + "_" for k in entry.queries()}
