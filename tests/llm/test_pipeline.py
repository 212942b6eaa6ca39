import random

import corpus_pipeline
from exposcan.llm import toxicity
from exposcan.llm.decontaminate import leaks
from exposcan.llm.mixing import mixture
from tests.llm.fixtures import cut_down, docs, frame, groups, prose
from tests.llm.test_learned import labelled


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage on what the one before it kept."""
    rng = random.Random(1)
    texts, labels = labelled(3, 260)
    passage, item = " ".join(prose(rng, 60)), " ".join(prose(rng, 30))
    texts = [t + " " + passage if k % 9 == 0 else t for k, t in enumerate(texts)]
    texts += [texts[k] for k in range(0, 40, 2)] + [texts[k] + " more" for k in range(1, 41, 2)] + [" ".join(prose(rng, 80, 400)) + " " + item, "", None]
    documents = docs(spark, texts)
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame(spark, [(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    at, read = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, out = at, stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        assert at.columns == documents.columns
        old, new = ({r["doc_id"]: r["text"] for r in f.collect()} for f in (before, at))
        read[name] = new
        if name == "toxicity":
            found = toxicity.toxicity(before, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            assert set(new) == {r["doc_id"] for r in found.collect() if not r["predicted"]} and 0 < len(new) < len(old)
        elif name == "ngram_jaccard_join":
            assert set(new) == {i for i, (_, first) in groups(list(old.items())).items() if i == first} and len(new) < len(old)
        elif name == "substring_dedup":
            want = cut_down(list(old.items()))
            assert new == {i: (w[3] if w[1] else old[i]) for i, w in want.items() if not w[1] or w[3]} and new != old
        elif name == "benchmark_decontamination":
            bench = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
            assert set(old) - set(new) == {r["doc_id"] for r in leaks(before, bench).collect()} and len(new) < len(old)
        else:
            assert set(new) == {r["doc_id"] for r in mixture(before).collect() if r["kept"]} and new
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"]: r["text"] for r in run.collect()} == read["mixing"]
