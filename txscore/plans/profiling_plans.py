"""Column profiles and data quality."""

from txscore import fixtures
from txscore.operators import profiling
from txscore.operators.cleaning import clean_stream, coerce_timestamps, drop_missing
from txscore.operators.sampling import hash_split
from txscore.plans.oracle import DIRTY, REPEATED, SCORED, TX, over
from txscore.plans.registry import query
from txscore.schema import SCORED as SCORED_SCHEMA
from txscore.schema import TRANSACTION

_TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTION.fields}
_DIRTY_TYPES = {
    "trans_num": "string", "category": "string", "unix_time": "bigint", "is_fraud": "int",
    "amt": "double", "city_pop": "int", "copy_no": "int",
}
_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def _profile_sql(types: dict[str, str], table: str) -> str:
    return "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing_count,
       round_even((count(*) - count({c}))::DOUBLE / count(*) * 100 * 100, 0) / 100.0::DOUBLE
         AS missing_pct,
       count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) AS nunique
FROM {table}""" for c, t in types.items())


@query("column_profile", over(TX, DIRTY) + _profile_sql(_DIRTY_TYPES, "dirty"))
def column_profile(spark, sf_dir):
    return profiling.profile(fixtures.tx_dirty(spark, sf_dir))


@query("column_profile_lineitem", _profile_sql(_LINE_TYPES, "lineitem"))
def column_profile_lineitem(spark, sf_dir):
    return profiling.profile(fixtures.read_table(spark, sf_dir, "lineitem"))


@query("top_profile", over(TX) + "SELECT * FROM (" + _profile_sql(_TYPES, "tx") + """)
ORDER BY missing_pct DESC, nunique DESC, "column" LIMIT 15""")
def top_profile(spark, sf_dir):
    return profiling.top_profile(fixtures.tx(spark, sf_dir))


@query("dup_rows", over(TX, REPEATED) + """
SELECT (SELECT count(*) FROM repeated) - (SELECT count(*) FROM (SELECT DISTINCT * FROM repeated))
  AS duplicate_rows""")
def dup_rows(spark, sf_dir):
    return profiling.duplicate_rows(fixtures.tx_repeated(spark, sf_dir))


@query("dup_keys", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicate_keys FROM lineitem")
def dup_keys(spark, sf_dir):
    return profiling.duplicate_keys(fixtures.read_table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("label_rate", over(TX) + """
SELECT round_even(avg(is_fraud) * 100 * 1e6, 0) / 1e6 AS fraud_rate_pct FROM tx""")
def label_rate(spark, sf_dir):
    return profiling.label_rate(fixtures.tx(spark, sf_dir))


@query("schema_diff", over(TX, DIRTY) + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS \"column\", 'left' AS side, count(*) - count({c}) AS missing_count, "
     f"count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) AS nunique FROM tx"
     for c in _TYPES if c not in _DIRTY_TYPES]
    + ["SELECT 'copy_no' AS \"column\", 'right' AS side, 0::BIGINT AS missing_count, "
       "count(DISTINCT copy_no) AS nunique FROM dirty"]))
def schema_diff(spark, sf_dir):
    return profiling.one_sided_profile(
        spark, fixtures.tx(spark, sf_dir), fixtures.tx_dirty(spark, sf_dir))


_BUCKET = "('0x' || substr(md5(trans_num), 1, 8))::BIGINT % 10000"


@query("drift", over(TX) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) FILTER ({_BUCKET} < 8000) AS train_nunique, "
    f"count(DISTINCT {c}) FILTER ({_BUCKET} >= 8000) AS test_nunique FROM tx"
    for c in sorted(_TYPES)))
def drift(spark, sf_dir):
    return profiling.drift(*hash_split(fixtures.tx(spark, sf_dir)))


@query("quality_checks", over(TX) + """
, rough AS (SELECT CASE WHEN unix_time % 13 = 0 THEN NULL ELSE trans_date_trans_time END AS t, dob,
                   CASE WHEN unix_time % 23 = 0 THEN -amt ELSE amt END AS amt, trans_num
            FROM tx UNION ALL SELECT trans_date_trans_time, NULL, amt, trans_num
            FROM tx WHERE unix_time % 10 = 0)
SELECT 'missing_trans_time' AS "check", count(*) - count(t) AS count FROM rough
UNION ALL SELECT 'missing_dob', count(*) - count(dob) FROM rough
UNION ALL SELECT 'negative_amounts', count(*) FILTER (amt < 0) FROM rough
UNION ALL SELECT 'duplicate_trans_num', count(*) - count(DISTINCT trans_num) FROM rough""")
def quality_checks(spark, sf_dir):
    from pyspark.sql import functions as F

    clean = fixtures.tx(spark, sf_dir)
    rough = clean.select(
        F.expr("CASE WHEN unix_time % 13 = 0 THEN 'no date' ELSE trans_date_trans_time END")
        .alias("trans_date_trans_time"), "dob",
        F.expr("CASE WHEN unix_time % 23 = 0 THEN -amt ELSE amt END").alias("amt"), "trans_num",
    ).unionByName(clean.filter("unix_time % 10 = 0").select(
        "trans_date_trans_time", F.lit("never").alias("dob"), "amt", "trans_num"))
    return profiling.quality_checks(coerce_timestamps(rough))


_SCORED_TYPES = {f.name: f.dataType.simpleString() for f in SCORED_SCHEMA.fields}


@query("table_contract", over(TX, SCORED) + """
SELECT "column", expected, expected AS found, TRUE AS matches,
       (SELECT count(*) FROM scored) AS row_count
FROM (VALUES """ + ", ".join(f"('{c}', '{t}')" for c, t in _SCORED_TYPES.items())
       + """) v("column", expected)""")
def table_contract(spark, sf_dir):
    return profiling.table_contract(spark, fixtures.scored(spark, sf_dir), SCORED_SCHEMA)


@query("table_contract_mismatch", over(TX, SCORED) + """
SELECT "column", expected, CASE "column" WHEN 'amt' THEN 'string' WHEN 'is_fraud' THEN 'bigint'
                                          WHEN 'merchant' THEN NULL ELSE expected END AS found,
       "column" NOT IN ('amt', 'is_fraud', 'merchant') AS matches, (SELECT count(*) FROM scored) AS row_count
FROM (VALUES """ + ", ".join(f"('{c}', '{t}')" for c, t in _SCORED_TYPES.items()) + """) v("column", expected)
UNION ALL SELECT 'note', NULL, 'string', FALSE, (SELECT count(*) FROM scored)""")
def table_contract_mismatch(spark, sf_dir):
    """Two columns of another type, one that is absent, and one too many."""
    from pyspark.sql import functions as F

    rows = fixtures.scored(spark, sf_dir).withColumns({
        "amt": F.col("amt").cast("string"), "is_fraud": F.col("is_fraud").cast("bigint"), "note": F.lit("x")})
    return profiling.table_contract(spark, rows.drop("merchant"), SCORED_SCHEMA)


@query("stage_counts", over(TX, DIRTY) + """
SELECT 'in' AS stage, count(*) AS "rows" FROM dirty
UNION ALL SELECT 'known', count(*) FROM dirty WHERE amt IS NOT NULL
UNION ALL SELECT 'clean', count(*) FROM (
  SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY copy_no) AS n FROM dirty
  WHERE amt IS NOT NULL) WHERE n = 1 AND amt >= 0 AND city_pop >= 0""")
def stage_counts(spark, sf_dir):
    dirty = fixtures.tx_dirty(spark, sf_dir)
    return profiling.stage_counts({
        "in": dirty, "known": drop_missing(dirty), "clean": clean_stream(dirty, order=["copy_no"])})
