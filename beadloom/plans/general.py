"""Queries of the general data-pipeline operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.operators import heavy_keys, packed_fields, proximity, sheet_lines
from beadloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

PACKED = ["flex_probe_barcode_ids", "lane", "sb_lane"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


@query(
    "p2_found",
    """
    WITH p AS (SELECT bead_id, upper(trim(sb)) AS sb, x, y, puck_index, floor(x / 2) AS gx, floor(y / 2) AS gy FROM puck
               WHERE sb IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)),
    n AS (SELECT p.* REPLACE (gx + dx AS gx, gy + dy AS gy) FROM p, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy))
    SELECT a.bead_id AS bead_a, b.bead_id AS bead_b FROM p a JOIN n b USING (puck_index, gx, gy)
    WHERE a.bead_id < b.bead_id AND a.sb <> b.sb AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 4
    """,
)
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return proximity.close_beads(table(spark, sf, "puck"), 2.0)


@query(
    "p2_in_region",
    """
    WITH b AS (SELECT s_suppkey AS box, (s_suppkey % 3 + 1)::INT AS g, s_suppkey * 37 % 400 - 100.0 AS x0, s_suppkey * 53 % 400 - 100.0 AS y0 FROM supplier)
    SELECT p.bead_id, b.box FROM puck p JOIN b ON p.puck_index = b.g
    WHERE NOT isnan(x) AND NOT isnan(y) AND x BETWEEN x0 AND x0 + 60 AND y BETWEEN y0 AND y0 + 40
    """,
)
def p2_in_region(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s_suppkey")
    boxes = table(spark, sf, "supplier").select(
        s.alias("box"), (s % 3 + 1).cast("int").alias("g"), (s * 37 % 400 - 100.0).alias("x0"), (s * 37 % 400 - 40.0).alias("x1"),
        (s * 53 % 400 - 100.0).alias("y0"), (s * 53 % 400 - 60.0).alias("y1"),
    )
    points = table(spark, sf, "puck").select(F.col("puck_index").alias("g"), F.col("bead_id").alias("ident"), "x", "y")
    return proximity.points_in_boxes(points, boxes, 20.0).withColumnRenamed("ident", "bead_id")


#: Tiles a side that each puck's extent is cut into.
TILES = 4


@query(
    "p2_in_tiles",
    f"""
    WITH p AS (SELECT * FROM puck WHERE puck_index IS NOT NULL AND isfinite(x) AND isfinite(y)),
    e AS (SELECT puck_index AS g, min(x) AS lx, max(x) AS hx, min(y) AS ly, max(y) AS hy FROM p GROUP BY 1),
    k AS (SELECT unnest(range({TILES})) AS k),
    b AS (SELECT g, g::BIGINT * {TILES**2} + i.k * {TILES} + j.k AS box, lx + (hx - lx) * i.k / {TILES} AS x0, CASE WHEN i.k = {TILES - 1} THEN hx ELSE lx + (hx - lx) * (i.k + 1) / {TILES} END AS x1,
                 ly + (hy - ly) * j.k / {TILES} AS y0, CASE WHEN j.k = {TILES - 1} THEN hy ELSE ly + (hy - ly) * (j.k + 1) / {TILES} END AS y1 FROM e, k i, k j)
    SELECT bead_id, box FROM p JOIN b ON puck_index = g WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1
    """,
)
def p2_in_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """A region search over every puck: the tiles of each puck's extent; a bead on an edge is in each tile it touches."""
    puck = table(spark, sf, "puck")
    placed = puck.filter("puck_index IS NOT NULL AND abs(x) < double('inf') AND abs(y) < double('inf')")
    ends = placed.groupBy(F.col("puck_index").alias("g")).agg(F.min("x").alias("lx"), F.max("x").alias("hx"), F.min("y").alias("ly"), F.max("y").alias("hy"))
    steps = F.sequence(F.lit(0), F.lit(TILES - 1))
    cells = ends.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps))

    def edge(a: str, k: str, upper: bool) -> Column:
        lo, hi, n = F.col(f"l{a}"), F.col(f"h{a}"), F.col(k) + int(upper)
        return F.when(n == TILES, hi).otherwise(lo + (hi - lo) * n / TILES)

    boxes = cells.select(
        "g", (F.col("g").cast("long") * TILES**2 + F.col("i") * TILES + F.col("j")).alias("box"),
        edge("x", "i", False).alias("x0"), edge("x", "i", True).alias("x1"), edge("y", "j", False).alias("y0"), edge("y", "j", True).alias("y1"),
    )
    points = puck.select(F.col("puck_index").alias("g"), F.col("bead_id").alias("ident"), "x", "y")
    return proximity.points_in_boxes(points, boxes, 20.0).withColumnRenamed("ident", "bead_id")


_CELLS = " UNION ALL ".join(f"SELECT row_id, '{f}' AS field_name, {f} AS cell FROM example_metadata" for f in PACKED)
_BLANK = r"^[\s ]+|[\s ]+$"


@query(
    "p3_found",
    rf"""
    WITH c AS ({_CELLS}),
    t AS (SELECT row_id, field_name, regexp_replace(cell, '{_BLANK}', '', 'g') AS cell FROM c WHERE cell IS NOT NULL),
    u AS (SELECT row_id, field_name, CASE WHEN regexp_full_match(cell, '"[^"]*"|''[^'']*''|“[^”]*”|‘[^’]*’', 's') THEN substr(cell, 2, length(cell) - 2) ELSE cell END AS cell FROM t),
    p AS (SELECT row_id, field_name, unnest(regexp_extract_all(cell, '"[^"]*"|''[^'']*''|“[^”]*”|‘[^’]*’|[A-Za-z0-9*_-]+', 0, 's')) AS piece,
                 generate_subscripts(regexp_extract_all(cell, '"[^"]*"|''[^'']*''|“[^”]*”|‘[^’]*’|[A-Za-z0-9*_-]+', 0, 's'), 1) AS nth FROM u),
    v AS (SELECT row_id, field_name, nth, CASE WHEN left(piece, 1) IN ('"', '''', '“', '‘') THEN substr(piece, 2, length(piece) - 2) ELSE piece END AS item_text FROM p)
    SELECT row_id, field_name, row_number() OVER (PARTITION BY row_id, field_name ORDER BY nth)::INT AS pos, item_text
    FROM v WHERE regexp_matches(item_text, '[A-Za-z0-9*_-]')
    """,
)
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    made = packed_fields.unpack(table(spark, sf, "example_metadata"), "row_id", PACKED)
    return made.select("row_id", "field_name", "pos", "item_text")


#: Planted cells: two or three of 32 IDs, a third of the cells without separators.
_K = "(row_id * 7 + {} * row_id // 32 + {}) % 16 + 1"


@query(
    "p3_glued",
    f"""
    WITH i AS (SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'BC' ELSE 'AB' END || lpad(({_K.format(3, 0)})::VARCHAR, 3, '0') AS a,
                      'BC' || lpad(({_K.format(5, 4)})::VARCHAR, 3, '0') AS b, 'AB' || lpad(({_K.format(11, 9)})::VARCHAR, 3, '0') AS c FROM example_metadata),
    v AS (SELECT row_id, CASE WHEN row_id % 5 = 0 THEN [a, b, c] ELSE [a, b] END AS v FROM i)
    SELECT row_id, unnest(range(1, len(v) + 1))::INT AS pos, unnest(v) AS item_text FROM v
    """,
)
def p3_glued(spark: SparkSession, sf: str) -> DataFrame:
    """Values that stand side by side without a separator, told apart by learned frequencies; a cell is planted for every row of the table."""
    r, pad = F.col("row_id"), lambda tag, k: F.concat(tag, F.lpad(k.cast("string"), 3, "0"))
    of = lambda m, c: (r * 7 + F.floor(m * r / 32) + c) % 16 + 1
    a, b, c = pad(F.when(r % 2 == 0, "BC").otherwise("AB"), of(3, 0)), pad(F.lit("BC"), of(5, 4)), pad(F.lit("AB"), of(11, 9))
    sep = F.when(r % 3 == 0, "").otherwise(F.when(r % 7 == 0, "; ").otherwise(","))
    cell = F.concat(a, sep, b, F.when(r % 5 == 0, F.concat(sep, c)).otherwise(""))
    return packed_fields.unpack(table(spark, sf, "example_metadata").select("row_id", cell.alias("cell")), "row_id", ["cell"], glue=100.0).select("row_id", "pos", "item_text")


_FIELD = r'"(?:[^"]|"")*"|[^"{0}]*'


def _parsed(sep: str, tail: str) -> str:
    field = _FIELD.format(sep)
    return f"""
    SELECT raw_id, regexp_full_match(line, '(?:{field})(?:{sep}(?:{field}))*', 's') AS whole,
           regexp_extract_all(line || '{tail}', '({field}){sep}', 1, 's') AS f FROM kept WHERE {"" if sep != "," else "NOT "}tsv"""


_SHEET = rf"""
    WITH l AS (SELECT raw_id, lower(coalesce(file_name, '')) LIKE '%.tsv' AS tsv, regexp_replace(line, '\r$', '') AS line FROM metadata_raw WHERE line IS NOT NULL),
    kept AS (SELECT * FROM l WHERE NOT regexp_full_match(line, '\x{{feff}}?[ \r\n]*') AND line NOT LIKE '#%' AND NOT regexp_matches(line, '^\x{{feff}}?"?Run"?[,\t]"?Email"?[,\t]')),
    parsed AS ({_parsed(",", ",")} UNION ALL {_parsed("	", "	")}),
    g AS (SELECT raw_id, whole, len(f) AS n, list_transform(f, lambda v: CASE WHEN left(v, 1) = '"' THEN replace(substr(v, 2, length(v) - 2), '""', '"') ELSE v END) AS g FROM parsed),
    t AS (SELECT *, list_transform(g, lambda v: regexp_replace(v, '^\s+|\s+$', '', 'g')) AS f FROM g),
    r AS (SELECT raw_id, g, CASE
        WHEN NOT whole THEN 'broken_quote' WHEN n <> 18 THEN 'column_count'
        WHEN f[7] <> '' AND NOT regexp_full_match(f[7], 'SI-[A-Z][A-Z]-[A-H](?:[1-9]|1[0-2])') THEN 'rna_index'
        WHEN NOT regexp_full_match(f[11], 'P[0-9]{{5}}') THEN 'puck_id'
        WHEN f[12] <> '' AND NOT (regexp_full_match(f[12], '[0-9]{{8}}_[A-Z0-9]+') AND try_strptime(left(f[12], 8), '%Y%m%d') IS NOT NULL) THEN 'merge_bcl' END AS reason FROM t)"""


@query("p4_found", f"{_SHEET} SELECT raw_id, reason FROM r WHERE reason IS NOT NULL")
def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return sheet_lines.bad_lines(table(spark, sf, "metadata_raw"))


@query("p4_rows", f"{_SHEET} SELECT raw_id, " + ", ".join(f"g[{k}] AS {c}" for k, c in enumerate(sheet_lines.FIELD_NAMES, 1)) + " FROM r WHERE reason IS NULL")
def p4_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sheet_lines.good_rows(table(spark, sf, "metadata_raw"))


_KEYS = """
    WITH k AS (SELECT 'cb_index' AS key_field, cb_index AS key_id, reads FROM molecules UNION ALL SELECT 'sb_index', sb_index, reads FROM molecules),
    t AS (SELECT key_field, key_id, count(*)::BIGINT AS n_rows, sum(coalesce(reads, 0))::BIGINT AS reads FROM k WHERE key_id IS NOT NULL GROUP BY 1, 2)"""


@query("p5_found", f"{_KEYS} SELECT key_field, key_id FROM t WHERE reads > 0 AND reads * 100 >= 4 * (SELECT sum(reads) FROM molecules)")
def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return heavy_keys.dominant_keys(table(spark, sf, "molecules"), 4)


@query("p5_key_totals", f"{_KEYS} SELECT * FROM t")
def p5_key_totals(spark: SparkSession, sf: str) -> DataFrame:
    return heavy_keys.key_totals(table(spark, sf, "molecules"))
