"""The pipeline against what its stages say of their own input."""

import corpus_pipeline
from pyspark.sql import functions as F
from test_circulant import brute as groups
from test_decontaminate import brute as contaminated
from test_secrets import brute as secrets
from txscore.llm.langid import held_out, identify, learn, least_of, least_scores
from txscore.llm.tasks import written_table


def test_stages(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = written_table(stage(spark, docs, sf_dir), name)
        after = {r.doc_id: r for r in out.collect()}
        if name == "language_id":
            teachers = docs.filter(~held_out(F.col("doc_id")))
            least = least_scores(teachers, learn(teachers))
            kept = {r.doc_id for r in identify(docs).collect() if r.lang_pred != "und"
                    and r.score >= least_of(least, r.lang_pred, len(before[r.doc_id].encode()))}
            assert least and set(after) == kept and len(kept) > 0.99 * len(before)
        elif name == "near_dedup":
            assert set(after) == {i for i, (_, _, keep) in groups(list(before.items()), 5).items() if keep}
            assert len(after) < len(before)
        elif name == "decontamination":
            assert set(after) == {r[0] for r in contaminated(list(before.items()), items) if not r[5]}
            assert len(after) < len(before)
        elif name == "secret_scan":
            assert set(after) == set(before)
            changed = {i for i in before if after[i].text != before[i]}
            assert changed >= {i for i in before if secrets(before[i])}
            assert all("[SECRET]" in after[i].text for i in changed)
            assert not any(secrets(r.text) for r in after.values())
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            assert set(after) == set(before) and all(r.lossless for r in after.values())
        if name != "sentencepiece":
            assert out.columns == columns
        docs = out


def test_edges(spark, edge_docs, no_docs, sf_dir):
    for docs in (edge_docs, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written_table(stage(spark, docs, sf_dir), name)
            if name != "sentencepiece":
                assert docs.columns == columns
        docs.collect()


def test_run_is_all_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids", "lossless"]
