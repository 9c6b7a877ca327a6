"""Domain views over the driver's tables, once as DataFrames and once as SQL.

The tables hold molecules, not reads; a read pair is made of every molecule row by integer arithmetic that both
engines share, with the linker and the barcode damaged in every way the read classes know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.functions.seq import BARCODE, LINKER, UMI, dna, umi_decode
from beadloom.operators import molecules as M
from beadloom.runtime import spread, table

#: The linker with one and with two bases exchanged, and with one left out.
ONE_OFF, TWO_OFF, SHORT = LINKER[:4] + "A" + LINKER[5:], LINKER[:4] + "A" + LINKER[5:10] + "T" + LINKER[11:], LINKER[:9] + LINKER[10:]


def sql_dna(v: str, n: int) -> str:
    return f"array_to_string(list_transform(range({n - 1}, -1, -1), lambda i: substr('ACTG', (1 + (({v} >> (2 * i)::INT) & 3))::INT, 1)), '')"


def sql_umi(v: str) -> str:
    return f"array_to_string(list_transform(range(0, {UMI}), lambda i: substr('ACTG', (1 + (({v} >> (2 * i)::INT) & 3))::INT, 1)), '')"


def reads(spark: SparkSession, sf: str) -> DataFrame:
    """``pair_id, cb_index, umi_2bit, sb_index, kind, cell, r1, r2``."""
    m = spread(table(spark, sf, "molecules").filter("cb_index IS NOT NULL AND sb_index IS NOT NULL").select("cb_index", "umi_2bit", "sb_index", "reads"))
    sb = table(spark, sf, "sb_list").withColumnRenamed("barcode", "sb")
    cb = table(spark, sf, "cb_list").withColumnRenamed("barcode", "known")
    kind = (F.col("umi_2bit") * 7 + F.col("sb_index") * 3 + F.coalesce("reads", F.lit(0))) % 24
    r = m.join(sb, "sb_index").join(cb, "cb_index", "left").withColumn("kind", kind)
    cell = F.coalesce("known", dna((F.abs("cb_index") * 2654435761) % (1 << 32), 16))
    umi = umi_decode("umi_2bit")
    k = F.col("kind")
    umi = F.when(k == 23, F.overlay(umi, F.lit("N"), 5, 1)).when(k == 22, F.lit("AAAAAAAAAAAC")).otherwise(umi)
    at = (F.col("umi_2bit") % BARCODE + 1).cast("int")
    other = F.translate(F.substring("sb", at, F.lit(1)), "ACGTN", "TGCAA")
    hit = F.overlay("sb", other, at, F.lit(1))
    twice = F.overlay(hit, F.translate(F.substring("sb", (at % BARCODE) + 1, F.lit(1)), "ACGTN", "GTACC"), (at % BARCODE) + 1, F.lit(1))
    one, two = lambda s: F.substring(s, 1, 8), lambda s: F.substring(s, 9, 6)
    c = lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v for v in x))
    s = F.col("sb")
    r2 = (
        F.when(k == 9, c(one(s), ONE_OFF, two(s))).when(k == 10, c(one(s), "G" * 18, two(s))).when(k == 11, c(F.substring(s, 2, 7), LINKER, two(s), "A"))
        .when(k == 12, c(F.substring(s, 2, 7), ONE_OFF, two(s), "C")).when(k == 13, c(one(s), SHORT, two(s), "T")).when(k == 14, c(one(s), TWO_OFF, two(s)))
        .when(k == 15, c(one(s), "ACGTACGTACGTACGTAC", two(s))).when(k.isin(16, 17), c(one(hit), LINKER, two(hit))).when(k == 18, c(one(s), LINKER, F.substring(s, 10, 5), "G"))
        .when(k == 19, c(F.substring(s, 1, 7), LINKER, two(s), "A")).when(k == 20, c(one(twice), LINKER, two(twice))).otherwise(c(one(s), LINKER, two(s)))
    )
    made = F.struct((F.col("sb_index") % 4).cast("int").alias("pair_id"), "cb_index", "umi_2bit", "sb_index", "kind", cell.alias("cell"), F.concat(cell, umi).alias("r1"), r2.alias("r2"))
    # a generator between: reads stand for a scanned table, so what they are made of is not copied into every expression over them
    return r.select(F.inline(F.array(made)))


_AT = f"(umi_2bit % {BARCODE} + 1)"
_HIT = f"(substr(sb, 1, plc - 1) || translate(substr(sb, plc, 1), 'ACGTN', 'TGCAA') || substr(sb, plc + 1))"
_NEXT = f"(plc % {BARCODE} + 1)"
READS = [
    f"""rr AS (SELECT m.cb_index, m.umi_2bit, m.sb_index, s.barcode AS sb, (m.umi_2bit * 7 + m.sb_index * 3 + coalesce(m.reads, 0)) % 24 AS kind, {_AT} AS plc,
        coalesce(c.barcode, {sql_dna("((abs(m.cb_index) * 2654435761) % 4294967296)", 16)}) AS cell, {sql_umi("m.umi_2bit")} AS umi
        FROM molecules m JOIN sb_list s ON s.sb_index = m.sb_index LEFT JOIN cb_list c ON c.cb_index = m.cb_index WHERE m.cb_index IS NOT NULL AND m.sb_index IS NOT NULL)""",
    f"rh AS (SELECT *, {_HIT} AS hit FROM rr)",
    f"rt AS (SELECT *, substr(hit, 1, {_NEXT} - 1) || translate(substr(sb, {_NEXT}, 1), 'ACGTN', 'GTACC') || substr(hit, {_NEXT} + 1) AS twice FROM rh)",
    f"""reads AS (SELECT (sb_index % 4)::INT AS pair_id, cb_index, umi_2bit, sb_index, kind, cell,
        cell || CASE kind WHEN 23 THEN substr(umi, 1, 4) || 'N' || substr(umi, 6) WHEN 22 THEN 'AAAAAAAAAAAC' ELSE umi END AS r1,
        CASE kind WHEN 9 THEN left(sb, 8) || '{ONE_OFF}' || substr(sb, 9, 6) WHEN 10 THEN left(sb, 8) || repeat('G', 18) || substr(sb, 9, 6)
          WHEN 11 THEN substr(sb, 2, 7) || '{LINKER}' || substr(sb, 9, 6) || 'A' WHEN 12 THEN substr(sb, 2, 7) || '{ONE_OFF}' || substr(sb, 9, 6) || 'C'
          WHEN 13 THEN left(sb, 8) || '{SHORT}' || substr(sb, 9, 6) || 'T' WHEN 14 THEN left(sb, 8) || '{TWO_OFF}' || substr(sb, 9, 6)
          WHEN 15 THEN left(sb, 8) || 'ACGTACGTACGTACGTAC' || substr(sb, 9, 6) WHEN 16 THEN left(hit, 8) || '{LINKER}' || substr(hit, 9, 6)
          WHEN 17 THEN left(hit, 8) || '{LINKER}' || substr(hit, 9, 6) WHEN 18 THEN left(sb, 8) || '{LINKER}' || substr(sb, 10, 5) || 'G'
          WHEN 19 THEN left(sb, 7) || '{LINKER}' || substr(sb, 9, 6) || 'A' WHEN 20 THEN left(twice, 8) || '{LINKER}' || substr(twice, 9, 6)
          ELSE left(sb, 8) || '{LINKER}' || substr(sb, 9, 6) END AS r2 FROM rt)""",
]


def sql_mismatches(a: str, b: str, n: int) -> str:
    return f"list_sum(list_transform(range(1, {n + 1}), lambda i: (substr({a}, i::INT, 1) <> substr({b}, i::INT, 1))::INT))"


_UMI_STATE = "CASE WHEN umi LIKE '%N%' THEN 'umi_N' WHEN " + " OR ".join(f"length(replace(umi, '{b}', '')) <= 2" for b in "ACGTN") + " THEN 'umi_homopolymer' ELSE 'ok' END"
_OFF, _OFF_LEFT = sql_mismatches("here", f"'{LINKER}'", 18), sql_mismatches("lft", f"'{LINKER}'", 18)
_SHORTS = ", ".join(f"'{LINKER[:k] + LINKER[k + 1 :]}'" for k in range(18))
STATES = [
    *READS,
    "rs AS (SELECT *, substr(r1, 17, 12) AS umi, substr(r2, 9, 18) AS here, substr(r2, 8, 18) AS lft, substr(r2, 9, 17) AS short FROM reads)",
    f"rm AS (SELECT *, {_UMI_STATE} AS umi_state, {_OFF} AS off, {_OFF_LEFT} AS off_left FROM rs)",
    """st AS (SELECT *, CASE WHEN off = 0 THEN 'exact' WHEN off = 1 THEN '-1X' WHEN length(replace(here, 'G', '')) <= 3 THEN 'GG' WHEN off_left = 0 THEN '1D-'
        WHEN off_left = 1 THEN '1D-1X' WHEN short IN (""" + _SHORTS + """) THEN '-1D' WHEN off = 2 THEN '-2X' ELSE 'none' END AS linker FROM rm)""",
    """hv AS (SELECT *, CASE WHEN linker IN ('1D-', '1D-1X') THEN left(r2, 7) ELSE left(r2, 8) END AS sb1,
        CASE WHEN linker IN ('1D-', '1D-1X', '-1D') THEN substr(r2, 26, 6) ELSE substr(r2, 27, 6) END AS sb2 FROM st)""",
]
DICTIONARY = [
    "d0 AS (SELECT sb_index, barcode, length(barcode) - length(replace(barcode, 'N', '')) AS n FROM sb_list WHERE length(barcode) = 14)",
    """hd AS (SELECT sb_index, f, p AS pos FROM (SELECT sb_index, barcode, p, substr(barcode, 1, p - 1) || b || substr(barcode, p + 1) AS f
        FROM (SELECT * FROM d0 WHERE n = 0), (SELECT unnest(range(1, 15)) AS p), (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS b)) WHERE f <> barcode)""",
    """fz AS (SELECT left(f, 8) AS sb1, substr(f, 9) AS sb2, sb_index, pos FROM hd
        UNION ALL SELECT substr(barcode, 1, p - 1) || substr(barcode, p + 1, 8 - p), substr(barcode, 9), sb_index, -p FROM (SELECT * FROM d0 WHERE n = 0), (SELECT unnest(range(1, 9)) AS p)
        UNION ALL SELECT left(f, 8), substr(f, 9), sb_index, pos FROM (SELECT sb_index, instr(barcode, 'N') AS pos, unnest([barcode, replace(barcode, 'N', 'A'), replace(barcode, 'N', 'C'), replace(barcode, 'N', 'G'), replace(barcode, 'N', 'T')]) AS f FROM d0 WHERE n = 1))""",
    "ex AS (SELECT left(barcode, 8) AS sb1, substr(barcode, 9) AS sb2, sb_index, 0 AS pos FROM d0 WHERE n = 0)",
    """dict AS (SELECT * FROM ex UNION ALL SELECT sb1, sb2, CASE WHEN count(*) > 1 THEN 0 ELSE min(sb_index) END, CASE WHEN count(*) > 1 THEN 0 ELSE min(pos) END
        FROM fz ANTI JOIN ex USING (sb1, sb2) GROUP BY sb1, sb2)""",
    """dict2 AS (SELECT sb1, sb2, CASE WHEN count(*) > 1 THEN 0 ELSE min(sb_index) END AS sb_index, CASE WHEN count(*) > 1 THEN 0 ELSE min(pos) END AS pos
        FROM (SELECT left(barcode, 8) AS sb1, substr(barcode, 9, p - 1) || substr(barcode, 9 + p) AS sb2, sb_index, -(8 + p) AS pos FROM (SELECT * FROM d0 WHERE n = 0), (SELECT unnest(range(1, 7)) AS p)) GROUP BY sb1, sb2)""",
]
MATCHED = [
    *STATES, *DICTIONARY,
    "ok AS (SELECT * FROM hv WHERE umi_state = 'ok' AND linker NOT IN ('GG', 'none'))",
    """mt AS (SELECT o.* EXCLUDE (sb_index), CASE WHEN a.sb_index > 0 AND a.pos = 0 THEN 'exact' WHEN a.sb_index > 0 THEN 'HD1' WHEN a.sb_index = 0 THEN 'HD1ambig' WHEN b.sb_index > 0 THEN 'SB2del'
        WHEN b.sb_index = 0 THEN 'SB2delambig' ELSE 'none' END AS match, nullif(coalesce(a.sb_index, b.sb_index), 0) AS sb_index, coalesce(a.pos, b.pos) AS pos
        FROM ok o LEFT JOIN dict a ON a.sb1 = o.sb1 AND a.sb2 = o.sb2 LEFT JOIN dict2 b ON b.sb1 = o.sb1 AND b.sb2 = left(o.sb2, 5))""",
]

# --- molecules and beads ---

MOLECULES = [
    """mol AS (SELECT cb_index, umi_2bit, sb_index, coalesce(sum(reads), 0)::BIGINT AS reads FROM molecules
        WHERE cb_index IS NOT NULL AND umi_2bit IS NOT NULL AND sb_index IS NOT NULL GROUP BY ALL)""",
    """chim AS (SELECT cb_index, umi_2bit, sb_index, reads, NOT (row_number() OVER w = 1 AND coalesce(lead(reads) OVER w < reads, true)) AS chimeric
        FROM mol WINDOW w AS (PARTITION BY cb_index, umi_2bit ORDER BY reads DESC, sb_index))""",
]
_DEGENERATE = "greatest(" + ", ".join(f"length(sb) - length(replace(sb, '{b}', ''))" for b in "ACGTN") + ")"
#: Beads of low complexity take no part in matching by edits.
SQL_COMPLEX = _DEGENERATE.replace("sb", "barcode") + " <= floor(length(barcode) * 0.8)"
_RUN = "coalesce(list_max(list_transform(regexp_extract_all(sb, 'A+|C+|G+|T+|N+'), lambda r: length(r))), 0)"
BEADS = [
    "pk AS (SELECT bead_id, upper(trim(sb)) AS sb, x, y, puck_index FROM puck WHERE sb IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y))",
    f"qc AS (SELECT *, count(*) OVER (PARTITION BY sb) > 1 AS is_dup, sb LIKE '%N%' AS is_n, {_DEGENERATE} > 10 OR {_RUN} > 7 AS is_degenerate FROM pk)",
    """sc AS (SELECT puck_index, CASE WHEN count(*) < 150000 THEN 0.73 WHEN count(*) < 600000 THEN 1.46 ELSE 0.645 END::DOUBLE AS k FROM puck GROUP BY 1)""",
    "um AS (SELECT bead_id, sb, puck_index, x * k AS x, y * k AS y FROM qc JOIN sc USING (puck_index) WHERE NOT is_dup AND NOT is_n AND NOT is_degenerate)",
    """eg AS (SELECT puck_index, x0, y0, x1, coalesce(sum(x1 - x0) OVER (ORDER BY puck_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
        FROM (SELECT puck_index, min(x) AS x0, max(x) AS x1, min(y) AS y0 FROM um GROUP BY 1))""",
    "lay AS (SELECT bead_id, sb, puck_index, x - x0 + st AS x_um, y - y0 AS y_um FROM um JOIN eg USING (puck_index))",
    "bd AS (SELECT s.sb_index, x_um, y_um, puck_index FROM lay JOIN sb_list s ON s.barcode = lay.sb)",
]
CELL_BEADS = [
    *MOLECULES, *BEADS,
    """sg AS (SELECT c.cb_index, c.umi_2bit, c.sb_index, c.reads, CASE WHEN chimeric THEN 'chimeric' WHEN b.sb_index IS NULL THEN 'lowQsb' WHEN c.cb_index <= 0 THEN 'uncalled' ELSE 'final' END AS stage
        FROM chim c LEFT JOIN bd b ON b.sb_index = c.sb_index)""",
    "cu AS (SELECT cb_index, sb_index, count(*) AS umi FROM sg WHERE stage = 'final' AND reads > 0 GROUP BY ALL)",
    "pb AS (SELECT sb_index, sum(umi)::BIGINT AS umi FROM cu GROUP BY 1)",
    "hi AS (SELECT sb_index FROM pb WHERE umi > (SELECT quantile_cont(umi, 0.99) FROM pb))",
    "cell_bead AS (SELECT cu.cb_index, x_um, y_um, cu.umi FROM cu ANTI JOIN hi USING (sb_index) JOIN bd USING (sb_index))",
]


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    return M.matrix(table(spark, sf, "molecules"))


def beads(spark: SparkSession, sf: str) -> DataFrame:
    return M.placed_beads(table(spark, sf, "puck"), table(spark, sf, "sb_list"))


def cell_beads(spark: SparkSession, sf: str) -> DataFrame:
    return M.cell_beads(matrix(spark, sf), beads(spark, sf))
