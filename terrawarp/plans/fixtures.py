"""Input relations of the query catalogue, derived from the supplied tables by integer arithmetic.

The tables hold no imagery, so rasters, file lists and labels are made from whole tables. Each text below is SQL that
both engines read; {table} stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FIXTURES = {
    "scenes": """SELECT o_orderkey AS scene_id, 300 + (o_orderkey * 37) % 2000 AS width, 300 + (o_custkey * 53) % 2000 AS height FROM {orders}""",
    "names": """SELECT o_orderkey AS id, CASE o_orderkey % 9
        WHEN 0 THEN CAST(o_orderkey AS STRING) || '_' || CAST(o_custkey % 100 AS STRING) || '_train_image.tif'
        WHEN 1 THEN CAST(o_orderkey AS STRING) || '_' || CAST(o_custkey % 100 AS STRING) || '_image.tif'
        WHEN 2 THEN CAST(o_orderkey AS STRING) || '_b_c_d_annotation.tif'
        WHEN 3 THEN CAST(o_orderkey AS STRING) || '_image.tif'
        WHEN 4 THEN '_b_annotation.png' WHEN 5 THEN CAST(o_orderkey AS STRING) || '__image'
        WHEN 6 THEN CAST(o_orderkey AS STRING) || '_b_Image.tif' WHEN 7 THEN CAST(o_orderkey AS STRING) || '_1.5_Val_annotation.tar.gz'
        ELSE 'x' END AS name FROM {orders}""",
    "listing": """SELECT r.root_idx, r.role_dir, '/data/root' || CAST(r.root_idx AS STRING) || '/' || r.role_dir || '/' || r.name AS path, r.name FROM (
        SELECT x.root_idx, x.role_dir, CAST(x.k AS STRING) || '_' || CAST(x.c % 100 AS STRING)
            || CASE x.k % 5 WHEN 0 THEN '_train' WHEN 1 THEN '_val' WHEN 2 THEN '_test' WHEN 3 THEN '_Val' ELSE '' END
            || '_' || CASE WHEN x.k % 17 = 0 AND x.role_dir = 'annotation' THEN 'label' WHEN x.k % 41 = 0 THEN 'annotation' ELSE x.role_dir END || '.tif' AS name
        FROM (SELECT o_orderkey AS k, o_custkey AS c, 0 AS root_idx, 'image' AS role_dir FROM {orders}
              UNION ALL SELECT o_orderkey, o_custkey, 0, 'annotation' FROM {orders} WHERE o_orderkey % 13 <> 0
              UNION ALL SELECT o_orderkey, o_custkey, 1, 'image' FROM {orders} WHERE o_orderkey % 23 = 0) x) r""",
    "georef": """SELECT c_custkey AS scene_id, CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE 3000 + c_nationkey END AS epsg, c_nationkey % 4 = 1 AS is_local,
        0.25 AS a, (c_custkey % 3) / 8.0 AS b, c_acctbal AS c, (c_custkey % 5) / 8.0 AS d, -0.25 AS e, 6400000.0 + c_custkey AS f,
        300 + (c_custkey * 37) % 900 AS width, 300 + (c_custkey * 53) % 900 AS height FROM {customer}""",
    "boxes": """SELECT o_orderkey % 50 AS scene_id, o_orderkey AS list_pos, o_orderkey % 4 AS class_value, o_custkey % 3 AS draw_order,
        CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST((o_orderkey * 7) % 60 AS DOUBLE) + 0.5 END AS x0, CAST((o_custkey * 11) % 60 AS DOUBLE) AS y0,
        CAST((o_orderkey * 7) % 60 AS DOUBLE) + 0.5 + CASE WHEN o_orderkey % 31 = 0 THEN -1 ELSE 1 + o_orderkey % 5 END AS x1,
        CAST((o_custkey * 11) % 60 AS DOUBLE) + 1 + o_custkey % 4 AS y1 FROM {orders}""",
    "small": """SELECT s_suppkey AS scene_id, 12 + s_suppkey % 9 AS width, 12 + (s_suppkey * 3) % 7 AS height FROM {supplier}""",
    "pairs25": """SELECT l_linenumber % 4 AS raw, (l_orderkey + l_partkey) % 3 AS pred FROM {lineitem}""",
    "logits": """SELECT vec_id, embedding, label FROM {embeddings}""",
    "log": """SELECT user_id AS run, event_id AS step, value AS metric FROM {events}""",
}
_TABLE = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FIXTURES[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in set(_TABLE.findall(text))})


def sql(name: str) -> str:
    """The fixture as a DuckDB subquery."""
    return _TABLE.sub(r"\1", FIXTURES[name])


#: Expressions of pixel values that both engines share.
PROBS = tuple(f"CAST(((x * {p} + y * {q} + read_x * {r} + read_y * {s} + scene_id) % 16) AS DOUBLE) / 16" for p, q, r, s in ((7, 13, 3, 5), (5, 3, 11, 7), (3, 11, 5, 13)))
