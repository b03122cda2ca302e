"""Reports of the parts of a database."""

from pyspark.sql import functions as F

from policyscan.operators import quality


def test_a_part_is_judged_like_a_database_of_its_own(spark):
    rows = [(f"CKV_AWS_{k}", "HIGH" if k % 10 else "LOW") for k in range(1, 41)]
    rows += [(f"CKV_GCP_{k}", ("HIGH", "LOW")[k % 2]) for k in range(20)]
    rows += [("CKV_AZURE_X1", "HIGH"), ("CKV_AZURE_2", "odd"), ("CKV_AZURE_3", None), (None, "LOW"), ("plain", "LOW")]
    table = spark.createDataFrame(rows, "checkov_id string, severity string")
    part = F.try_element_at(F.split("checkov_id", "_"), F.lit(2))
    for version in ("1.0", None):
        parts = {r.part: r.asDict() for r in quality.part_reports(table, part, version).collect()}
        assert set(parts) == {"AWS", "GCP", "AZURE", None}
        for name, got in parts.items():
            own = table.filter(part.eqNullSafe(name))
            alone = quality.database_report(own, version, own.count()).first().asDict()
            assert {k: v for k, v in got.items() if k != "part"} == alone
    assert parts["AWS"]["info_count"] == 1 and parts["GCP"]["info_count"] == 0
    assert quality.part_reports(table.limit(0), part, "1.0").collect() == []
