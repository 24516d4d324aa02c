"""Queries on keys beyond those of the small tables, against their SQL."""

from quire.queries import registry

from .oracle import connect, differences


def test_crop_results_of_keys_of_seven_digits(spark, tmp_path):
    keys = [1, 2, 3, 4, 99999, 100000, 100001, 999998, 999999, *range(1000000, 1000030), 1200000, 12345678]
    spark.createDataFrame([(k,) for k in keys], "p_partkey bigint").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = connect(tmp_path / "none")
    con.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    assert differences(spark, con, registry.queries()["crop_results"], registry.oracle_sql()["crop_results"], str(tmp_path)) == ""
