"""The pipeline against the stages' brute-force counterparts."""

import awkward
import numpy as np
from test_pairs import bits_by_force, groups_by_force
from test_scans import folded
from tokenizers import Tokenizer

import corpus_pipeline
from assaysieve.llm import quality, queries, secrets

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_by_force(spark):
    documents, labels, benchmark = (queries.table(spark, FOLDER, t) for t in ("documents", "labels", "benchmark"))
    kept = {r["doc_id"] for r in quality.digest(documents, labels).where("kept").collect()}
    rows = [r for r in documents.orderBy("doc_id").collect() if r["doc_id"] in kept]
    label = groups_by_force([bits_by_force(r["text"]) for r in rows], 4)
    rows = [r for n, r in enumerate(rows) if label[n] == n]
    windows = {tuple(w[p:p + 10]) for w in (folded(r["text"]) for r in benchmark.collect()) for p in range(len(w) - 9)}
    public, want = Tokenizer.from_file(queries.VOCABULARY), []
    for r in rows:
        w = folded(r["text"])
        hit = {i for p in range(len(w) - 9) if tuple(w[p:p + 10]) in windows for i in range(p, p + 10)}
        if len(hit) > 0.5 * len(w):
            continue
        if hit:
            want.append((r["doc_id"], None))  # cut: the length below tells
            continue
        text = r["text"]
        for kind, a, b in reversed(secrets.find(text)):
            if not any(x <= a and b <= y for _, x, y in secrets.find(text) if (x, y) != (a, b)):
                text = text[:a] + f"[{kind}]" + text[b:]
        want.append((r["doc_id"], public.encode(text, add_special_tokens=False).ids))
    got = {r["doc_id"]: np.frombuffer(r["token_ids"], "<u4").tolist() for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert sorted(got) == sorted(i for i, _ in want)
    for i, ids in want:
        if ids is not None:
            assert got[i] == ids
        else:
            assert not {tuple(w[p:p + 10]) for w in [folded(public.decode(got[i], skip_special_tokens=False))] for p in range(len(w) - 9)} & windows


def test_stages_survive_awkward_rows(spark, tmp_path):
    folder = str(tmp_path)
    awkward.labels(spark).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, awkward.prose(7, 60))], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for docs in (awkward.documents(spark, clashes=True), awkward.empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
