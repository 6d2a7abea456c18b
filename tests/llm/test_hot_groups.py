"""A third of the rows in one group of copies, next to many small groups."""

import pytest
from pyspark.sql import functions as F

from placepulse.llm import exact_dedup, warc
from placepulse.operators import joins


def test_exact_dedup_of_hot_and_small_groups(spark):
    ids = spark.range(6000).repartition(12)
    text = F.when(F.col("id") % 3 == 0, "same  text").otherwise(F.concat(F.lit("pair "), F.floor(F.col("id") / 6).cast("string")))
    got = {r["doc_id"]: r for r in exact_dedup.find_copies(ids.select(F.col("id").alias("doc_id"), text.alias("text"))).collect()}
    groups = {}
    for i in range(6000):
        groups.setdefault("same text" if i % 3 == 0 else f"pair {i // 6}", []).append(i)
    for members in groups.values():
        for i in members:
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (members[0], len(members), i == members[0])
    assert len(got) == 6000


def test_exact_dedup_of_a_hot_group_without_ids(spark):
    docs = spark.range(3000).select(F.when(F.col("id") >= 2000, F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") < 2000, " ").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.find_copies(docs).collect()
    none = [r for r in got if r["doc_id"] is None]
    assert len(got) == 3000 and len(none) == 2000
    assert all(r["keep_id"] is None and r["group_size"] == 2000 for r in none)
    assert all(r["kept"] and r["group_size"] == 1 and r["keep_id"] == r["doc_id"] for r in got if r["doc_id"] is not None)


@pytest.mark.parametrize("limit", [joins.BROADCAST_ROWS, 1])
def test_revisits_of_a_hot_payload(spark, tmp_path, monkeypatch, limit):
    """By broadcast and by the salted join."""
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (limit, joins.BROADCAST_BYTES))
    text = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.floor(F.col("id") / 6).cast("string"))
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("http://a.x/").alias("url"), text.alias("html"))
    warc.write_warc(pages.repartition(7), str(tmp_path / "w"))
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    groups = {}
    for i in range(600):
        groups.setdefault("hot" if i % 3 == 0 else str(i // 6) if i % 3 == 1 else "", []).append(i)
    want = {i: ("response", None) if i == found[0] else ("revisit", found[0]) for found in groups.values() for i in found}
    assert got == want
