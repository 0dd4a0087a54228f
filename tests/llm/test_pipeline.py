"""The pipeline's stages against plain Python over what each stage was given."""

import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
from reelweave.llm import mixture, simhash, toxicity
from reelweave.llm.common import stored
from reelweave.llm.queries import vocabulary
from test_line_spread import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    results = [{r.doc_id: r for r in docs.collect()}]
    copies = None
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER))
        rows = docs.collect()
        if name == "mixing":
            copies = rows
        if name != "bpe":
            assert docs.columns == columns
        results.append({r.doc_id: r for r in rows})
    given, clean, lines, unique, _, _ = results

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    network = toxicity.train(*toxicity.training_rows(source, labels))
    scores = toxicity.Scorer(network).scores([r.text for r in given.values()])
    assert clean == {k: r for (k, r), s in zip(given.items(), scores, strict=True) if s < 0.5}

    assert {k: r.text for k, r in lines.items()} == plain_lines([(r.doc_id, r.text, r.source) for r in clean.values()], 5)
    want = plain_components({k: plain_fingerprint(r.text) for k, r in lines.items()})
    assert unique == {k: r for k, r in lines.items() if want[k] == k}

    plan = mixture.plan_mix(spark.createDataFrame(list(unique.values()))).collect()
    taken = {r.doc_id: r.taken for r in plan if r.taken}
    words = Counter()
    for r in copies:
        words[r.doc_id] += len(r.text.split())
        assert r.text == unique[r.doc_id].text or unique[r.doc_id].text.split()[: len(r.text.split())] == r.text.split()
    assert dict(words) == taken

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    ids = [tokenizer.encode(r.text, add_special_tokens=False).ids for r in copies]
    digests = [hashlib.sha256(np.array(i, dtype="<u4").tobytes()).hexdigest() for i in ids]
    final = docs.collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in final) == sorted(
        (r.doc_id, len(i), d) for r, i, d in zip(copies, ids, digests, strict=True)
    )


def test_run_and_odd_documents(spark, tmp_path):
    rows = [(1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (2, None, None, None, None), (None, "x y z v w", "en", "t", 9), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in found.collect()} <= {1, None}
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_near_duplicates_of_the_pipeline_are_not_broadcast_by_list(spark, monkeypatch):
    """The lists of its fingerprints, 56 to each, would go through the driver while their files still look small."""
    plans, components = [], simhash.connected_components

    def look(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components(links)

    monkeypatch.setattr(simhash, "connected_components", look)
    rows = [(k, f"word{k} a b c d{k % 3}", "en", "s", 9) for k in range(40)] * 2
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars INT")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert {r.doc_id for r in kept.collect()} <= set(range(40))
    assert len(plans) == 1 and "Broadcast" not in plans[0]
