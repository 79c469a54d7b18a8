from quillon.config import Limits
from quillon.registry import audits

SF = "/root/testdata/sf0.001"


def test_rounds_of_admission_reach_every_shard(spark, monkeypatch):
    monkeypatch.setattr(audits, "Limits", lambda **o: Limits(**{**o, "records_per_shard": 40, "max_concurrent_jobs": 2}))
    n = spark.read.parquet(f"{SF}/part.parquet").count()
    shards = -(-n // 40)
    assert shards > 2 * 2  # more than two rounds
    found = {r.name: r["count"] for r in audits.workspace_report(spark, SF).collect()}
    assert found["embed_ok"] == found["upserted"] == found["count_match PASS"] == n
    assert found["SUCCEEDED"] == shards and "PENDING" not in found
