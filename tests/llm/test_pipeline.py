from collections import Counter

import duckdb

import corpus_pipeline as C
from kpiflow.llm import quality
from kpiflow.llm.common import cut, table
from kpiflow.llm.queries import OP9_SQL
from tests.llm.test_decontam import brute as brute_leaks
from tests.llm.test_minhash import brute as brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark):
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for k, (_, stage) in enumerate(C.STAGES):
        docs = cut(stage(spark, docs, SF))
        now = {r.doc_id for r in docs.collect()}
        assert now <= ids and now
        assert docs.columns == (columns if k + 1 < len(C.STAGES) else [*columns, "shard", "slot"])
        ids = now
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_empty_and_odd_tables(spark, no_docs, wide_docs):
    for docs in (no_docs, wide_docs):
        columns = docs.columns
        for k, (_, stage) in enumerate(C.STAGES):
            docs = stage(spark, docs, SF)
            assert docs.columns == (columns if k + 1 < len(C.STAGES) else [*columns, "shard", "slot"])
            docs = cut(docs)
        if columns == no_docs.columns:
            assert docs.count() == 0
        else:
            assert docs.count() > 0 and docs.filter("`_doc` <> 'own _doc'").count() == 0


def test_each_stage_against_brute_force(spark):
    """What every stage keeps of its own input, recomputed without its operator."""
    docs = table(spark, SF, "documents")
    for name, stage in C.STAGES:
        out = cut(stage(spark, docs, SF))
        before, after = docs.collect(), Counter(r.doc_id for r in out.collect())
        if name == "quality":  # the scores themselves are checked in test_quality
            labels = table(spark, SF, "labels")
            scored = quality.quality_digest(docs, labels).collect()
            assert after == Counter(r.doc_id for r in scored if r.score >= 0.3)
        elif name == "near_duplicates":
            groups = brute_groups([(r.doc_id, r.text) for r in before])
            assert after == Counter(i for (i, _), (n, first) in groups.items() if i == first)
        elif name == "decontamination":
            leaks = brute_leaks([(r.doc_id, r.text) for r in before], [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
            assert after == Counter(r.doc_id for r in before if r.doc_id not in {d for d, _ in leaks})
        elif name == "mixing":
            con = duckdb.connect()
            con.register("documents", docs.toArrow())
            mixed = con.execute(f"SELECT doc_id, size, taken FROM ({OP9_SQL})").fetchall()
            assert after == Counter({i: taken // size for i, size, taken in mixed if taken})
        else:
            assert after == Counter(r.doc_id for r in before)
            size = Counter()
            for r in out.collect():
                size[r.shard] += len((r.text or "").encode()) + 1
            assert set(size) == set(range(C.SHARDS)) and max(size.values()) - min(size.values()) <= 2 * max(len((r.text or "").encode()) + 1 for r in before)
        docs = out
