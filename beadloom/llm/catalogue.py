"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beadloom.llm import frequent, language, leakage, markov, mixture
from beadloom.runtime import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


_PATCHES = """
    WITH RECURSIVE p AS (SELECT bead_id, upper(trim(sb)) AS barcode, x, y, puck_index FROM puck WHERE sb IS NOT NULL),
    o AS (SELECT barcode FROM p GROUP BY 1 HAVING count(*) = 1),
    b AS (SELECT * FROM p SEMI JOIN o USING (barcode) WHERE x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)),
    n AS (SELECT DISTINCT cb_index, bead_id, puck_index, x, y FROM molecules JOIN sb_list USING (sb_index) JOIN b USING (barcode) WHERE cb_index > 0),
    e AS (SELECT a.cb_index, a.bead_id AS a, b.bead_id AS b FROM n a JOIN n b USING (cb_index, puck_index) WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 < 400),
    r AS (SELECT cb_index, a, b FROM e UNION SELECT r.cb_index, r.a, e.b FROM r JOIN e ON r.cb_index = e.cb_index AND r.b = e.a),
    g AS (SELECT cb_index, a AS bead_id, min(b) AS head_bead_id FROM r GROUP BY ALL)
    SELECT cb_index, bead_id, head_bead_id FROM g QUALIFY count(*) OVER (PARTITION BY cb_index, head_bead_id) >= 5"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return markov.bead_patches(table(spark, sf, "molecules"), table(spark, sf, "sb_list"), table(spark, sf, "puck"))


@query("p1_found", _PATCHES)
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _members(spark, sf).filter("patch_size >= 5").select("cb_index", "bead_id", "head_bead_id")


@query("p1_patches")
def p1_patches(spark: SparkSession, sf: str) -> DataFrame:
    return markov.patches(_members(spark, sf))


_TOP = """
    WITH i AS (SELECT 'puck.sb' AS item_field, upper(trim(sb)) AS item, 10 AS k FROM puck UNION ALL SELECT 'molecules.sb_index', sb_index::VARCHAR, 12 FROM molecules),
    c AS (SELECT item_field, item, k, count(*) AS n FROM i WHERE item IS NOT NULL GROUP BY ALL)
    SELECT item_field, item{} FROM c QUALIFY row_number() OVER (PARTITION BY item_field ORDER BY n DESC, item) <= k"""


@query("p6_found", _TOP.format(""))
def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return frequent.frequent_barcodes(table(spark, sf, "puck"), table(spark, sf, "molecules")).select("item_field", "item")


@query("p6_intervals")
def p6_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return frequent.frequent_barcodes(table(spark, sf, "puck"), table(spark, sf, "molecules"))


_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(
    "p7_found",
    rf"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), i AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
    ds AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k : k + 12], ' '))) AS run FROM d WHERE len(w) >= 13),
    ix AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k : k + 12], ' '))) AS run FROM i WHERE len(w) >= 13)
    SELECT DISTINCT doc_id, item_id FROM ds JOIN ix USING (run)
    """,
)
def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


@query("p7_near")
def p7_near(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.near_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


@query("p8_mix")
def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets")).documents


@query("p8_shares")
def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixture.mix(table(spark, sf, "documents"), table(spark, sf, "mix_targets")).shares


@query("p9_found")
def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.mislabelled_lines(table(spark, sf, "documents"))


@query("p9_segments")
def p9_segments(spark: SparkSession, sf: str) -> DataFrame:
    return language.segments(language.line_languages(table(spark, sf, "documents")))


@query("p9_documents")
def p9_documents(spark: SparkSession, sf: str) -> DataFrame:
    return language.document_languages(language.line_languages(table(spark, sf, "documents")))
