"""Queries over sample sheets, reports and logs, and the profile path's read counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beadloom.functions import formats as N
from beadloom.functions import seq
from beadloom.operators import dictionary as D
from beadloom.operators import metadata as S
from beadloom.operators import profile_reads as R
from beadloom.plans import views as V
from beadloom.plans.registry import Catalogue, with_
from beadloom.runtime import beside, table

query = Catalogue()
QUERIES, ORACLE = query.queries, query.oracle


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "example_metadata")


_CLEAN = lambda c: f"coalesce(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"
_NORM = "nm AS (SELECT row_id, " + ", ".join(f"{_CLEAN(c)} AS {c}" for c in S.CONTENT) + " FROM example_metadata)"
_SEL = "sl AS (SELECT * FROM nm WHERE row_id IN (SELECT row_id FROM example_metadata WHERE upper(run) IN ('YES', 'Y')))"
_ALL = ", ".join(S.CONTENT)
_OTHERS = [c for c in S.CONTENT if c not in ("bcl", "sample_name")]


@query("metadata_select", "SELECT bcl, count(*) AS n, count(*) FILTER (upper(run) IN ('YES', 'Y')) AS n_run FROM example_metadata GROUP BY 1")
def metadata_select(spark: SparkSession, sf: str) -> DataFrame:
    return _meta(spark, sf).groupBy("bcl").agg(F.count("*").alias("n"), F.count_if(F.upper("run").isin("YES", "Y")).alias("n_run"))


@query("metadata_dedupe", with_([_NORM], f"SELECT min(row_id) AS row_id, count(*) AS n_rows, {_ALL} FROM nm GROUP BY {_ALL}"))
def metadata_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return S.without_repeats(_meta(spark, sf))


_DIFF = " || ".join(f"CASE WHEN count(DISTINCT {c}) > 1 THEN ',{c}' ELSE '' END" for c in _OTHERS)


@query("metadata_conflicts", with_([_NORM, f"u AS (SELECT DISTINCT {_ALL} FROM nm)"], f"SELECT bcl, sample_name, count(*) AS n_versions, substr({_DIFF}, 2) AS differing FROM u GROUP BY 1, 2 HAVING count(*) > 1"))
def metadata_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return S.conflicts(_meta(spark, sf))


@query("metadata_mixed_runs", with_([_NORM, _SEL], "SELECT bcl, count(DISTINCT nullif(species, '')) > 1 AS many_species, count(DISTINCT nullif(chemistry, '')) > 1 AS many_chemistries FROM sl GROUP BY 1 HAVING count(DISTINCT nullif(species, '')) > 1 OR count(DISTINCT nullif(chemistry, '')) > 1"))
def metadata_mixed_runs(spark: SparkSession, sf: str) -> DataFrame:
    return S.mixed_runs(_meta(spark, sf))


@query("samplesheet", with_([_NORM, _SEL], "SELECT * FROM (SELECT bcl, sample_name AS sample, unnest(string_split(lane, ',')) AS lane, rna_index AS index FROM sl WHERE rna_index <> '') WHERE lane <> '' UNION ALL SELECT bcl, sample_name || '_sb', unnest(string_split(sb_lane, ',')), sb_index FROM sl WHERE sb_index <> ''"))
def samplesheet(spark: SparkSession, sf: str) -> DataFrame:
    return S.library_rows(_meta(spark, sf))


@query("library_faults", with_([_NORM, _SEL], "SELECT row_id, 'indexless' AS fault FROM sl WHERE rna_index = '' AND merge_rna_from_bcl = '' UNION ALL SELECT row_id, 'no_spatial' FROM sl WHERE sb_index = '' AND merge_spatial_from_bcl = ''"))
def library_faults(spark: SparkSession, sf: str) -> DataFrame:
    return S.library_faults(_meta(spark, sf))


@query("merged_runs", with_([_NORM, _SEL, "b AS (SELECT bcl, 0 AS kind, merge_rna_from_bcl AS other, row_id FROM sl UNION ALL SELECT bcl, 1, merge_spatial_from_bcl, row_id FROM sl)"],
    "SELECT bcl, other, row_number() OVER (PARTITION BY bcl ORDER BY min(kind * 1e12 + row_id))::INT AS nth FROM b WHERE other <> '' AND other <> bcl GROUP BY bcl, other"))
def merged_runs(spark: SparkSession, sf: str) -> DataFrame:
    return S.merged_runs(_meta(spark, sf))


@query("lane_tokens", r"""SELECT row_id, CASE WHEN lane IS NULL OR len(list_filter(string_split(lane, ','), lambda x: NOT regexp_full_match(regexp_replace(x, '^\s+|\s+$', '', 'g'), '[+-]?[0-9]+'))) > 0 THEN ''
    ELSE array_to_string(list_transform(string_split(lane, ','), lambda x: 'L' || lpad(regexp_replace(x, '^\s+|\s+$', '', 'g')::INT::VARCHAR, 3, '0')), ',') END AS tokens FROM example_metadata""")  # fmt: skip
def lane_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _meta(spark, sf).select("row_id", F.array_join(N.lane_tokens(F.col("lane")), ",").alias("tokens"))


@query("probe_split", r"SELECT row_id, unnest(list_filter(list_transform(regexp_split_to_array(flex_probe_barcode_ids, '[,|]'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS probe FROM example_metadata WHERE flex_probe_barcode_ids IS NOT NULL")
def probe_split(spark: SparkSession, sf: str) -> DataFrame:
    return _meta(spark, sf).select("row_id", F.explode(N.probe_ids(F.col("flex_probe_barcode_ids"))).alias("probe"))


@query("run_dates", "SELECT bcl, try_strptime(regexp_extract(bcl, '^([0-9]{8})_', 1), '%Y%m%d')::DATE AS run_date, count(*) AS n FROM example_metadata GROUP BY 1, 2")
def run_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _meta(spark, sf).groupBy("bcl", N.run_date(F.col("bcl")).alias("run_date")).agg(F.count("*").alias("n"))


@query("sample_names", r"SELECT row_id, coalesce(regexp_full_match(sample_name, '[A-Za-z0-9_-]+'), false) AS fine, regexp_replace(sample_name, '[^A-Za-z0-9_-]', '_', 'g') AS safe_name, CASE upper(species) WHEN 'HUMAN' THEN 'GRCh38' WHEN 'MOUSE' THEN 'GRCm39' END AS genome FROM example_metadata")
def sample_names(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("sample_name")
    genome = F.when(F.upper("species") == "HUMAN", "GRCh38").when(F.upper("species") == "MOUSE", "GRCm39")
    return _meta(spark, sf).select("row_id", F.coalesce(s.rlike("^[A-Za-z0-9_-]+$"), F.lit(False)).alias("fine"), F.regexp_replace(s, "[^A-Za-z0-9_-]", "_").alias("safe_name"), genome.alias("genome"))


_FILES = """fl AS (SELECT DISTINCT bcl, sample_name, m, r FROM sl, (SELECT unnest(['GEX', 'SB']) AS m), (SELECT unnest(['R1', 'R2']) AS r) WHERE CASE m WHEN 'GEX' THEN rna_index ELSE sb_index END <> ''),
    pr AS (SELECT * FROM fl WHERE (length(sample_name) * 7 + length(m) + length(bcl)) % 5 <> 0 AND NOT (r = 'R2' AND sample_name LIKE '%3'))"""


@query("fastq_missing", with_([_NORM, _SEL, _FILES], "SELECT bcl, sample_name, m AS mode, r AS read FROM fl ANTI JOIN pr USING (bcl, sample_name, m, r)"))
def fastq_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Files that the libraries need against files there; file names are made and taken apart again by their grammar."""
    s = S.normal(S.selected(_meta(spark, sf)))
    need = s.select("bcl", "sample_name", F.explode(F.expr("filter(array(named_struct('m', 'GEX', 'i', rna_index), named_struct('m', 'SB', 'i', sb_index)), x -> x.i <> '')")).alias("l")).select("bcl", "sample_name", F.col("l.m").alias("mode"))
    need = need.distinct().withColumn("read", F.explode(F.array(F.lit("R1"), F.lit("R2"))))
    there = need.filter("(length(sample_name) * 7 + length(mode) + length(bcl)) % 5 <> 0 AND NOT (read = 'R2' AND sample_name LIKE '%3')")
    name = F.concat("sample_name", F.lit("_"), "mode", F.lit("_S1_L001_"), "read", F.lit("_001.fastq.gz"))
    grammar = r"^(.+)_(GEX|SB)_S[0-9]+_L[0-9]{3}_(R[12])_[0-9]{3}\.fastq\.gz$"
    got = there.select("bcl", name.alias("f")).select("bcl", *(F.regexp_extract("f", grammar, k).alias(c) for k, c in ((1, "sample_name"), (2, "mode"), (3, "read"))))
    return S.missing_files(need, got, ["bcl", "sample_name", "mode", "read"])


@query("library_match", r"""SELECT l.row_id, m AS mode, count(*) AS n FROM (SELECT row_id, sample_name, sample_name || sfx AS lib FROM example_metadata, (SELECT unnest(['_GEX', '-sb_2', '', 'x_SB', '_gex-old']) AS sfx)) l, (SELECT unnest(['GEX', 'SB']) AS m)
    WHERE regexp_full_match(substr(lib, length(sample_name) + 1), '[_-]?(?i:' || m || ')(?:[_-].*)?') OR (m = 'GEX' AND lib = sample_name) GROUP BY 1, 2""")  # fmt: skip
def library_match(spark: SparkSession, sf: str) -> DataFrame:
    """Which library names belong to a sample: the sample's name, then the mode's token in any case."""
    libs = _meta(spark, sf).select("row_id", "sample_name", F.explode(F.array(*(F.concat("sample_name", F.lit(x)) for x in ("_GEX", "-sb_2", "", "x_SB", "_gex-old")))).alias("lib"))
    rest = F.substr(F.col("lib"), F.length("sample_name") + 1)
    hit = {m: rest.rlike(f"^[_-]?(?i:{m})([_-].*)?$") for m in ("GEX", "SB")}
    hit["GEX"] = hit["GEX"] | (F.col("lib") == F.col("sample_name"))
    both = libs.select("row_id", F.explode(F.filter(F.array(*(F.when(h, F.lit(m)) for m, h in hit.items())), lambda x: x.isNotNull())).alias("mode"))
    return both.groupBy("row_id", "mode").agg(F.count("*").alias("n"))


@query("stage_state", """SELECT bcl AS stage, CASE WHEN min(loaded_at) FILTER (reads > 40) IS NULL THEN 'missing' WHEN max(loaded_at) FILTER (reads <= 2) < min(loaded_at) FILTER (reads > 40) THEN 'fresh' ELSE 'stale' END AS state
    FROM molecules WHERE bcl IS NOT NULL GROUP BY 1""")  # fmt: skip
def stage_state(spark: SparkSession, sf: str) -> DataFrame:
    times = table(spark, sf, "molecules").filter("bcl IS NOT NULL").groupBy(F.col("bcl").alias("stage")).agg(
        F.max(F.when(F.col("reads") <= 2, F.col("loaded_at"))).alias("newest_input"), F.min(F.when(F.col("reads") > 40, F.col("loaded_at"))).alias("oldest_output"))
    return S.freshness(times)


# --- logs, pages, numbers ---


@query("log_scrape", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), h AS (SELECT doc_id, regexp_extract_all(line, '[0-9]+') AS n FROM l WHERE line LIKE '%barcodes%' AND regexp_matches(line, '[0-9]'))
    SELECT doc_id, count(*) AS n_lines, max(n[-1]::BIGINT) AS most FROM h GROUP BY 1""")  # fmt: skip
def log_scrape(spark: SparkSession, sf: str) -> DataFrame:
    """The last number of every line with a keyword."""
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").contains("barcodes") & F.col("line").rlike("[0-9]"))
    last = F.element_at(F.regexp_extract_all("line", F.lit("[0-9]+"), F.lit(0)), -1).cast("long")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.max(last).alias("most"))


_PAGE = """pg AS (SELECT user_id, max(event_id) AS m, min(event_id) AS k, count(*) AS n FROM events GROUP BY 1)"""


@query("knee_params", with_([_PAGE], "SELECT user_id, (k + n)::BIGINT AS expected_cells, (m + n)::BIGINT AS cliff_base_rank, (round_even((m + n + 5000) / 1000.0::DOUBLE, 0) * 1000)::BIGINT AS total_droplets FROM pg"))
def knee_params(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers out of the JSON that a report page carries: pages are made of events, then read like the pages of a run."""
    pg = table(spark, sf, "events").groupBy("user_id").agg(F.max("event_id").alias("m"), F.min("event_id").alias("k"), F.count("*").alias("n"))
    trace = lambda name, hi, text: F.format_string('{"name": "%s", "x": [1, %d], "text": ["%s"]}', F.lit(name), hi, F.lit(text))
    html = F.concat(F.lit('<html><script>const data = {"data": ['), trace("Cells", F.col("k") + F.col("n"), "100% Cells"), F.lit(", "), trace("Cells", F.col("m") + F.col("n"), "40% Cells"),
                    F.lit(", "), trace("Background", F.col("m") * 9, "0% Cells"), F.lit("]};</script></html>"))
    body = F.regexp_extract("html", r"(?s)const data = (\{.*\});?</script>", 1)
    data = pg.select("user_id", html.alias("html")).select("user_id", F.from_json(body, "data array<struct<name string, x array<long>, text array<string>>>").alias("d"))
    cells = F.filter("d.data", lambda t: (t["name"] == "Cells") & (F.size(t["x"]) > 0))
    full = F.filter(cells, lambda t: t["text"][0].rlike(r"^100%\s*Cells"))
    most = lambda a: F.array_max(F.transform(a, lambda t: F.array_max(t["x"])))
    out = data.select("user_id", most(full).alias("expected_cells"), most(cells).alias("cliff_base_rank"))
    return out.withColumn("total_droplets", (F.bround((F.col("cliff_base_rank") + 5000) / 1000.0, 0) * 1000).cast("long"))


@query("number_formats", r"""SELECT cb_index, count(*) AS n, sum(reads)::BIGINT AS reads, format('{:,}', sum(reads)::BIGINT) AS reads_text, printf('%.2f%%', count(*) * 100.0::DOUBLE / sum(reads)) AS share_text,
    round(count(*) * 100.0::DOUBLE / sum(reads), 2) AS share FROM molecules WHERE cb_index IS NOT NULL AND reads IS NOT NULL GROUP BY 1""")  # fmt: skip
def number_formats(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "molecules").filter("cb_index IS NOT NULL AND reads IS NOT NULL").groupBy("cb_index").agg(F.count("*").alias("n"), F.sum("reads").alias("reads"))
    text = N.percent_text(F.col("n") / F.col("reads"))
    return m.select("cb_index", "n", "reads", N.thousands("reads").alias("reads_text"), text.alias("share_text")).withColumn("share", N.parse_percent(F.col("share_text")))


# --- the profile path's reads ---

_RID = "rd AS (SELECT *, cb_index || ':' || umi_2bit || ':' || sb_index AS read_id, substr(r1, 1, 16) AS cb, substr(r1, 17, 12) AS umi FROM reads)"
_VALID = [*V.READS, _RID, f"v AS (SELECT *, length(r2) >= 32 AND {V.sql_mismatches('substr(r2, 9, 18)', chr(39) + seq.LINKER + chr(39), 18)} <= 1 AS linked, left(r2, 8) || substr(r2, 27, 6) AS sb FROM rd)",
    "pd AS (SELECT v.* FROM v WHERE linked AND cb IN (SELECT barcode FROM cb_list))"]


def _paired(spark: SparkSession, sf: str) -> DataFrame:
    """Both mates apart, each under its read's id, and put together again for listed cells."""
    r = V.reads(spark, sf).withColumn("read_id", F.concat_ws(":", "cb_index", "umi_2bit", "sb_index"))
    cb, umi = R.cell_and_umi("r1", "cell16_umi12")
    one = r.dropDuplicates(["read_id"]).select("read_id", cb.alias("cb"), umi.alias("umi"))
    two = r.filter(R.linker_ok("r2")).select("read_id", R.bead_barcode("r2").alias("sb"))
    return R.pair_by_id(one, two, table(spark, sf, "cb_list").select(F.col("barcode").alias("cb")))


@query("up_validate", with_(_VALID, "SELECT kind, count(*) AS n, count(*) FILTER (linked) AS n_linked FROM v GROUP BY 1"))
def up_validate(spark: SparkSession, sf: str) -> DataFrame:
    return V.reads(spark, sf).groupBy("kind").agg(F.count("*").alias("n"), F.count_if(R.linker_ok("r2")).alias("n_linked"))


@query("reads_per_sb", with_(_VALID, "SELECT sb, count(*) AS n FROM pd GROUP BY 1"))
def reads_per_sb(spark: SparkSession, sf: str) -> DataFrame:
    return _paired(spark, sf).groupBy("sb").agg(F.count("*").alias("n"))


@query("reads_per_cb", with_(_VALID, "SELECT cb, count(*) AS n FROM pd GROUP BY 1"))
def reads_per_cb(spark: SparkSession, sf: str) -> DataFrame:
    return _paired(spark, sf).groupBy("cb").agg(F.count("*").alias("n"))


@query("reads_per_cb_sb", with_(_VALID, "SELECT cb, sb, count(*) AS n FROM pd GROUP BY 1, 2"))
def reads_per_cb_sb(spark: SparkSession, sf: str) -> DataFrame:
    return _paired(spark, sf).groupBy("cb", "sb").agg(F.count("*").alias("n"))


@query("distinct_umi", with_(_VALID, "SELECT cb, sb, count(DISTINCT umi) AS n_umi FROM pd GROUP BY 1, 2"))
def distinct_umi(spark: SparkSession, sf: str) -> DataFrame:
    return _paired(spark, sf).groupBy("cb", "sb").agg(F.count_distinct("umi").alias("n_umi"))


@query("parser_summary", with_([*_VALID, "pc AS (SELECT cb, count(*) AS n FROM pd GROUP BY 1)"], """SELECT (SELECT count(*) FROM v) AS total_reads, (SELECT count(*) FROM v WHERE linked) AS linked_reads, (SELECT count(*) FROM cb_list) AS cells_listed,
    count(*) AS cells_matched, coalesce(sum(n), 0)::BIGINT AS reads_matched, coalesce(median(n), 0) AS median_reads, round(coalesce(avg(n), 0), 6) AS mean_reads FROM pc"""))  # fmt: skip
def parser_summary(spark: SparkSession, sf: str) -> DataFrame:
    r = V.reads(spark, sf).agg(F.count("*").alias("total_reads"), F.count_if(R.linker_ok("r2")).alias("linked_reads"))
    c = table(spark, sf, "cb_list").agg(F.count("*").alias("cells_listed"))
    p = _paired(spark, sf).groupBy("cb").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("cells_matched"), F.coalesce(F.sum("n"), F.lit(0)).alias("reads_matched"), F.coalesce(F.median("n"), F.lit(0.0)).alias("median_reads"), F.round(F.coalesce(F.avg("n"), F.lit(0.0)), 6).alias("mean_reads"))
    return beside(beside(r, c), p)


def _keys() -> tuple[list[str], list[str], list[str]]:
    """Three key tables made by a rule; a real library hands in its own."""
    made = lambda a: ["".join("ACTG"[((k * a + 7) >> (2 * i)) & 3] for i in range(9)) for k in range(96)]
    return made(677), made(911), made(1213)


def _key_sql(a: int, d: str) -> str:
    return f"array_to_string(list_transform(range(0, 9), lambda i: substr('ACTG', (1 + (((({d}) * {a} + 7) >> (2 * i)::INT) & 3))::INT, 1)), '')"


@query("index_to_barcode", f"SELECT sb_index, {_key_sql(677, '((sb_index - 1) // 9216) % 96')} || {_key_sql(911, '((sb_index - 1) // 96) % 96')} || {_key_sql(1213, '(sb_index - 1) % 96')} AS barcode FROM sb_list")
def index_to_barcode(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sb_list").select("sb_index", R.index_to_barcode(F.col("sb_index"), _keys()).alias("barcode"))


_LAYOUT_SQL = """s AS (SELECT sb_index, repeat(barcode, 3) || 'GTGATCGAG' || repeat(barcode, 2) AS s FROM sb_list), t AS (SELECT sb_index, substr(s, 1 + (sb_index % 9)::INT) AS s FROM s)"""


@query("platform_slices", with_([_LAYOUT_SQL], """SELECT sb_index, substr(s, 1, 16) AS cb_a, substr(s, 17, 12) AS umi_a, substr(s, 11, 8) || substr(s, 31, 8) || substr(s, 51, 8) AS cb_b, substr(s, 1, 10) AS umi_b,
    CASE WHEN i >= 0 AND length(s) >= 43 + i THEN substr(s, 1 + i, 9) || substr(s, 14 + i, 9) || substr(s, 27 + i, 9) ELSE '' END AS cb_c, CASE WHEN i >= 0 AND length(s) >= 43 + i THEN substr(s, 36 + i, 8) ELSE '' END AS umi_c
    FROM (SELECT *, instr(substr(s, 10, 7), 'GTGA') - 1 AS i FROM t)"""))  # fmt: skip
def platform_slices(spark: SparkSession, sf: str) -> DataFrame:
    b = F.col("barcode")
    s = F.concat(F.repeat(b, 3), F.lit("GTGATCGAG"), F.repeat(b, 2))
    t = table(spark, sf, "sb_list").select("sb_index", F.substring(s, (F.col("sb_index") % 9 + 1).cast("int"), F.lit(1000)).alias("s"))
    cols = [c.alias(f"{n}_{k}") for k, lay in zip("abc", ("cell16_umi12", "umi10_cell24", "cell27_linker")) for n, c in zip(("cb", "umi"), R.cell_and_umi("s", lay))]
    return t.select("sb_index", *cols)


_TAG_ROWS = ", ".join(f"('{c}', '{label}')" for label, codes in R.TAGS.items() for c in codes.split())
_TAGGED = [*V.READS, f"tg AS (SELECT * FROM (VALUES {_TAG_ROWS}) t(code, label))", f"tn AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS nth FROM tg)",
    "tr AS (SELECT reads.*, CASE WHEN (umi_2bit + sb_index) % 150 < 128 THEN code ELSE 'NNNNNNNN' END AS tag FROM reads LEFT JOIN tn ON nth = (umi_2bit + sb_index) % 150)",
    "dm AS (SELECT tr.*, label FROM tr LEFT JOIN tg ON tg.code = tr.tag)"]


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Read pairs with a sample tag at base 76, known for 128 of 150."""
    codes = sorted(c for v in R.TAGS.values() for c in v.split())
    k = (F.col("umi_2bit") + F.col("sb_index")) % 150
    tag = F.coalesce(F.try_element_at(F.array(*map(F.lit, codes)), (k + 1).cast("int")), F.lit("NNNNNNNN"))
    return R.demultiplex(V.reads(spark, sf).withColumn("r2", F.concat(F.rpad("r2", 75, "A"), tag)))


@query("demux_labels", with_(_TAGGED, "SELECT label, count(*) AS n, count(DISTINCT tag) AS n_codes FROM dm GROUP BY 1"))
def demux_labels(spark: SparkSession, sf: str) -> DataFrame:
    by_code = _tagged(spark, sf).groupBy("label", F.substring("r2", 76, 8).alias("code")).agg(F.count("*").alias("n"))
    return by_code.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("n_codes"))


@query("demux_summary", with_(_TAGGED, "SELECT label, n, pct, label IN ('AB001', 'AB002') OR pct >= 1 AS kept FROM (SELECT label, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS pct FROM dm WHERE label IS NOT NULL GROUP BY 1)"))
def demux_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.demux_summary(_tagged(spark, sf), ["AB001", "AB002"])


_EDIT = [*_VALID, f"w AS (SELECT DISTINCT barcode AS bead FROM sb_list WHERE {V.SQL_COMPLEX})", "ob AS (SELECT sb AS barcode, count(*) AS n_reads FROM pd GROUP BY 1)", "ex AS (SELECT barcode, bead, n_reads FROM ob JOIN w ON barcode = bead)", "lf AS (SELECT * FROM ob ANTI JOIN ex USING (barcode))",
    "cd AS (SELECT barcode, bead, n_reads FROM lf JOIN w ON left(barcode, 6) = left(bead, 6) UNION SELECT barcode, bead, n_reads FROM lf JOIN w ON substr(barcode, 5, 6) = substr(bead, 5, 6) UNION SELECT barcode, bead, n_reads FROM lf JOIN w ON substr(barcode, 9, 6) = substr(bead, 9, 6))",
    "mm AS (SELECT * FROM ex UNION ALL (SELECT * FROM cd WHERE levenshtein(barcode, bead) = 1 QUALIFY row_number() OVER (PARTITION BY barcode ORDER BY right(barcode, 1) <> right(bead, 1), bead) = 1))"]


def _edits(spark: SparkSession, sf: str) -> DataFrame:
    ob = _paired(spark, sf).groupBy(F.col("sb").alias("barcode")).agg(F.count("*").alias("n_reads"))
    beads = table(spark, sf, "sb_list").select(F.col("barcode").alias("bead")).distinct()
    return D.blocked_edit_match(ob.select("barcode"), beads).join(ob, "barcode", "left").withColumn("n_reads", F.coalesce("n_reads", F.lit(0)))


@query("mismatch_freq", with_(_EDIT, "SELECT pos::INT AS pos, coalesce(sum(n_reads) FILTER (substr(barcode, pos::INT, 1) <> substr(bead, pos::INT, 1)), 0)::BIGINT AS reads FROM mm, (SELECT unnest(range(1, 15)) AS pos) GROUP BY 1"))
def mismatch_freq(spark: SparkSession, sf: str) -> DataFrame:
    return R.mismatch_profile(_edits(spark, sf))


@query("useful_reads", with_([*_EDIT, "pc AS (SELECT cb, count(*) AS n FROM pd JOIN mm ON mm.barcode = pd.sb GROUP BY 1)"], "SELECT count(*) AS cells, sum(n)::BIGINT AS reads, round(median(n), 4) AS median_reads, round(avg(n), 4) AS mean_reads FROM pc"))
def useful_reads(spark: SparkSession, sf: str) -> DataFrame:
    per = _paired(spark, sf).join(_edits(spark, sf).select(F.col("barcode").alias("sb")), "sb", "left_semi").groupBy("cb").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("cells"), F.sum("n").alias("reads"), F.round(F.median("n"), 4).alias("median_reads"), F.round(F.avg("n"), 4).alias("mean_reads"))


# --- metrics ---

_METRICS = ["Total_readpairs", "Readpairs_with_proper_structure", "Readpairs_used", "Readpairs_matched"]
_ML = """ml AS (SELECT pair_id, count(*) AS Total_readpairs, count(*) FILTER (linked) AS Readpairs_with_proper_structure, count(*) FILTER (linked AND umi NOT LIKE '%N%') AS Readpairs_used,
    count(*) FILTER (linked AND cb IN (SELECT barcode FROM cb_list)) AS Readpairs_matched FROM v GROUP BY 1)"""
_LONG = "lg AS (" + " UNION ALL ".join(f"SELECT pair_id, {k} AS ord, '{m}' AS metric, {m} AS v FROM ml" for k, m in enumerate(_METRICS)) + ")"


def _long(spark: SparkSession, sf: str) -> DataFrame:
    """``pair_id, metric, v``: counters of each partition of the reads, one row per metric."""
    listed = table(spark, sf, "cb_list").select(F.col("barcode").alias("cb"), F.lit(True).alias("listed"))
    r = V.reads(spark, sf).select("pair_id", F.substring("r1", 1, 16).alias("cb"), F.substring("r1", 17, 12).alias("umi"), R.linker_ok("r2").alias("linked")).join(listed, "cb", "left")
    k = F.col("linked")
    wide = r.groupBy("pair_id").agg(F.count("*").alias(_METRICS[0]), F.count_if(k).alias(_METRICS[1]), F.count_if(k & ~F.col("umi").contains("N")).alias(_METRICS[2]), F.count_if(k & F.col("listed").isNotNull()).alias(_METRICS[3]))
    return wide.unpivot("pair_id", _METRICS, "metric", "v")


@query("metrics_long", with_([*_VALID, _ML, _LONG], "SELECT pair_id, metric, printf('%.0f', v::DOUBLE) AS value FROM lg UNION ALL SELECT pair_id, 'Pct_' || metric, printf('%.2f', CASE WHEN t = 0 THEN 0 ELSE v * 100.0::DOUBLE / t END) FROM (SELECT *, max(v) FILTER (ord = 0) OVER (PARTITION BY pair_id) AS t FROM lg) WHERE ord > 0"))
def metrics_long(spark: SparkSession, sf: str) -> DataFrame:
    m = _long(spark, sf)
    whole = F.max(F.when(F.col("metric") == _METRICS[0], F.col("v"))).over(Window.partitionBy("pair_id"))
    pct = m.withColumn("t", whole).filter(F.col("metric") != _METRICS[0])
    return m.select("pair_id", "metric", F.format_string("%.0f", F.col("v").cast("double")).alias("value")).unionByName(
        pct.select("pair_id", F.concat(F.lit("Pct_"), "metric").alias("metric"), F.format_string("%.2f", N.ratio_or_zero(F.col("v"), F.col("t"))).alias("value"))
    )


@query("metrics_merge", with_([*_VALID, _ML, _LONG], "SELECT metric, sum(v) FILTER (pair_id = 0)::BIGINT AS part_0, sum(v) FILTER (pair_id = 1)::BIGINT AS part_1, sum(v) FILTER (pair_id = 2)::BIGINT AS part_2, sum(v) FILTER (pair_id = 3)::BIGINT AS part_3, sum(v)::BIGINT AS total FROM lg GROUP BY 1"))
def metrics_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Partitions side by side and their sum; a metric that one of them lacks stays null there."""
    wide = _long(spark, sf).groupBy("metric").pivot("pair_id", [0, 1, 2, 3]).agg(F.sum("v"))
    parts = [F.col(str(k)).alias(f"part_{k}") for k in range(4)]
    return wide.select("metric", *parts, sum((F.coalesce(str(k), F.lit(0)) for k in range(4)), F.lit(0)).cast("long").alias("total"))


@query("metric_labels", with_([], "SELECT metric, CASE WHEN left(p, 2) = '% ' THEN '% ' || upper(substr(p, 3, 1)) || substr(p, 4) ELSE p END AS label FROM (SELECT metric, regexp_replace(replace(metric, '_', ' '), '^Pct', '%') AS p FROM (SELECT DISTINCT 'Pct_' || source || '_docs' AS metric FROM documents WHERE source IS NOT NULL))"))
def metric_labels(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "documents").filter("source IS NOT NULL").select(F.concat(F.lit("Pct_"), "source", F.lit("_docs")).alias("metric")).distinct()
    return m.select("metric", N.metric_label(F.col("metric")).alias("label"))


@query("partition_agreement", with_([_NORM], "SELECT bcl, count(DISTINCT puck_id) = 1 AS one_puck, count(DISTINCT chemistry) = 1 AS one_assay, count(*) AS n FROM nm GROUP BY 1"))
def partition_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Whether all rows of a run agree on one puck and one assay."""
    return S.normal(_meta(spark, sf)).groupBy("bcl").agg((F.min("puck_id") == F.max("puck_id")).alias("one_puck"), (F.min("chemistry") == F.max("chemistry")).alias("one_assay"), F.count("*").alias("n"))


@query("low_valid_runs", "SELECT bcl, count(*) AS n, round(count(*) FILTER (cb_index > 0) * 100.0::DOUBLE / count(*), 4) AS pct_valid FROM molecules GROUP BY 1 HAVING count(*) FILTER (cb_index > 0) * 2 < count(*)")
def low_valid_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of which less than half the rows belong to called cells."""
    n = table(spark, sf, "molecules").groupBy("bcl").agg(F.count("*").alias("n"), F.count_if(F.col("cb_index") > 0).alias("v"))
    return n.filter(F.col("v") * 2 < F.col("n")).select("bcl", "n", F.round(F.col("v") * 100.0 / F.col("n"), 4).alias("pct_valid"))


@query("bead_examples", with_(V.BEADS[:1], "SELECT sb, count(*) AS n FROM pk GROUP BY 1 HAVING count(*) > 1 ORDER BY sb LIMIT 5"))
def bead_examples(spark: SparkSession, sf: str) -> DataFrame:
    """The first five repeated barcodes, as a report shows them."""
    from beadloom.plans.molecule_queries import duplicate_beads

    return duplicate_beads(spark, sf).select("sb", "n").orderBy("sb").limit(5)


_LISTS = "ls AS (SELECT row_id, '[' || coalesce(sample_name, '') || ', ' || coalesce(puck_id, '') || ',]' AS list FROM example_metadata)"


@query("sample_lists", with_([_LISTS], "SELECT row_id, item FROM (SELECT row_id, trim(unnest(string_split(regexp_replace(list, '^\\[|\\]$', '', 'g'), ','))) AS item FROM ls) WHERE item <> ''"))
def sample_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Bracketed lists taken apart, empty parts left out."""
    text = F.concat(F.lit("["), F.coalesce("sample_name", F.lit("")), F.lit(", "), F.coalesce("puck_id", F.lit("")), F.lit(",]"))
    return _meta(spark, sf).select("row_id", F.explode(F.split(F.regexp_replace(text, r"^\[|\]$", ""), ",")).alias("item")).select("row_id", F.trim("item").alias("item")).filter("item <> ''")
