"""Product CSV files of any number of products, read in one set-wise pass.

Landing copies physical lines unchanged, tagged with the file split they came from and their place in it. Records
are parsed from the landed lines: each file keeps its own header, so products with different columns share a scan.

A quoted cell may hold line breaks, so whether a line begins a record depends on all lines before it. Each line is taken
as a function of that state (outside or inside a quoted cell) to the state after it; functions of two states compose to
functions of two states, first along the lines of a split, then along the splits of a file. Every split is thus parsed on
its own, and a record that crosses a border of splits is stitched together from its lines.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sluice.operators.ordinals import block_bases
from sluice.session import stage
from sluice.sources.listing import LOCAL, leaf_files, qualified, uri

_BLOCK = ("run_id", "file_path", "block_start")
# the dialect: comma, quotes doubled inside quotes, backslash is plain text
_CSV = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "multiLine": "true"}
# a line whose last cell opens with a quote and does not close; quotes inside an unquoted cell are plain text
_LEAVES_OPEN = r'^(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+\z'


@dataclass(frozen=True)
class Landed:
    """What landing leaves for harmonisation.

    rows: run_id, file_path, row_number, cells. headers: run_id, file_path, header.
    files: run_id, file_size for every run whose source exists. totals: run_id, total records.
    """

    rows: DataFrame
    headers: DataFrame
    files: DataFrame
    totals: DataFrame


def list_source_files(spark: SparkSession, root: str, runs: DataFrame) -> DataFrame:
    """source_key, file_path, file_size of the objects the runs' source keys name, or of the files below them.

    The exact paths go to Spark's file index, which looks them up in parallel (as a job if they are many) and passes over
    missing ones; nothing beside them is listed, and contents stay unread.
    """
    keys = sorted(r.source_key.strip("/") for r in runs.select("source_key").distinct().collect())
    base = qualified(spark, root)
    prefix = uri(spark, base).rstrip("/") + "/"
    found = leaf_files(spark, [f"{base}/{key}" for key in keys if key])
    rows = [(file, size, unquote(file.removeprefix(prefix))) for file, size in found]
    return spark.createDataFrame(rows, "file_path string, file_size bigint, source_key string")


def match_files(runs: DataFrame, listing: DataFrame) -> DataFrame:
    """Files of each run: the object its source key names, or the parts directly under it as a folder."""
    folder = F.regexp_replace("source_key", "/[^/]*$", "")
    part = F.regexp_extract("source_key", "([^/]*)$", 1)
    visible = listing.filter(~part.startswith("_") & ~part.startswith("."))
    keyed = visible.withColumn("source_key", F.explode(F.array_distinct(F.array("source_key", folder))))
    return runs.select("run_id", "source_key").join(keyed, "source_key").drop("source_key")


def _paths(files: DataFrame) -> list[str]:
    # file names only: the scan below keeps the same list in its file index
    return sorted(unquote(r.file_path) for r in files.select("file_path").distinct().collect())


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Physical lines with their split and place, as they are: blank ones too, and with a carriage return before the line
    feed. ``pos`` is consecutive within a split."""
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            F.regexp_replace("_metadata.file_path", LOCAL, "file:/").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.col("value").alias("line"),
        )
        .withColumn("pos", F.monotonically_increasing_id())
    )


def landed_lines(spark: SparkSession, files: DataFrame, runs: DataFrame) -> DataFrame | None:
    """Lines of the batch's files tagged with their run and its partition keys; None if there are no files."""
    paths = _paths(files.filter("file_size > 0"))
    if not paths:
        return None
    day = F.col("business_day")
    tags = files.join(
        runs.select(
            "run_id",
            "product",
            F.date_format(day, "yyyy").alias("year"),
            F.date_format(day, "MM").alias("month"),
            F.date_format(day, "dd").alias("day"),
        ),
        "run_id",
    ).drop("file_size")
    return scan_lines(spark, paths).join(stage(tags, "landing-files"), "file_path")


def _leaves_open(line: Column, inside: bool) -> Column:
    """Whether a line ends inside a quoted cell, if it begins inside one or not."""
    quoted = F.instr(line, '"') > 0
    if inside:
        return ~quoted | F.concat(F.lit('"'), line).rlike(_LEAVES_OPEN)
    return quoted & line.rlike(_LEAVES_OPEN)


def _body(line: Column) -> Column:
    """A line without the carriage return at its end."""
    return F.when(line.endswith("\r"), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def _cell_schema(width: int) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])


def split_cells(line: Column, width: int) -> Column:
    """Cells of a line. Unquoted lines split on commas; quoted ones go through Spark's CSV parser.

    ``width`` must cover the widest header: cells beyond a file's header belong to no column.
    """
    schema = _cell_schema(width)
    parsed = F.from_csv(line, schema.simpleString()[len("struct<") : -1].replace(":", " "), _CSV)
    cells = F.array(*[F.coalesce(parsed[f], F.lit("")) for f in schema.fieldNames()])
    return F.when(F.instr(line, '"') > 0, cells).otherwise(F.split(line, ",", -1))


def sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("run_id").agg(F.sum("file_size").alias("file_size"))


def nothing_landed(files: DataFrame) -> Landed:
    """Landing of files without a single line."""
    spark = files.sparkSession
    rows = spark.createDataFrame([], "run_id string, file_path string, row_number bigint, cells array<string>")
    no_header = F.array().cast("array<string>").alias("header")
    totals = spark.createDataFrame([], "run_id string, total bigint")
    return Landed(rows, files.select("run_id", "file_path", no_header), sizes(files), totals)


def parse_landed(lines: DataFrame, files: DataFrame) -> Landed:
    """Numbered records and headers of landed lines.

    In a plain file every line is a record, and numbers follow from the lines counted in each split. Files with a line that
    leaves a quoted cell open, a blank line or a lone carriage return are put together from their lines, split by split.
    """
    body = _body(F.col("line"))
    odd = (body == "") | (F.instr(body, "\r") > 0) | _leaves_open(F.col("line"), False)
    blocks = lines.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.max(odd).alias("odd"))
    blocks = stage(blocks, "blocks")
    by_file = stage(blocks.groupBy("run_id", "file_path").agg(F.max("odd").alias("odd"), F.sum("n").alias("lines")), "landed-files")
    plain = by_file.filter("not odd").select("run_id", "file_path")
    broken = by_file.filter("odd").select("run_id", "file_path")
    plain_blocks = blocks.join(plain, ["run_id", "file_path"]).drop("odd")
    # the first line of a plain file is its header
    heads_at = plain_blocks.groupBy("run_id", "file_path").agg(F.min(F.struct("block_start", "first")).alias("head"))
    # staged, so that its size is known and the lines aren't shuffled to it
    heads_at = stage(heads_at.select("run_id", "file_path", "head.block_start", F.col("head.first").alias("pos")), "head-places")
    heads = lines.select(*_BLOCK, "pos", body.alias("line")).join(heads_at, [*_BLOCK, "pos"]).select("run_id", "file_path", "line")
    counts = by_file.filter("not odd").select("run_id", "file_path", F.col("lines").alias("records"))
    spanning = None if broken.isEmpty() else stage(_stitched(lines, broken), "stitched")
    if spanning is not None:
        heads = heads.unionByName(spanning.filter("number = 1").select("run_id", "file_path", F.col("record").alias("line")))
        counts = counts.unionByName(spanning.groupBy("run_id", "file_path").agg(F.count(F.lit(1)).alias("records")))
    heads = stage(heads, "headers")
    width = heads.agg(F.max(F.size(F.split("line", ",", -1)))).first()[0] or 1
    clean_head = F.regexp_replace("line", r"^\uFEFF", "")
    commas = F.size(F.split("line", ",", -1))
    headers = heads.select(
        "run_id",
        "file_path",
        # the width bound counts quoted commas too; cells past the real header come back empty and are cut
        F.when(F.instr("line", '"') == 0, F.split(clean_head, ",", -1))
        .otherwise(
            F.slice(split_cells(clean_head, width), F.lit(1), commas - _quoted_commas(F.col("line")))
        )
        .alias("header"),
    )
    # files of a run follow one another by path; record 1 of each is its header
    in_run = block_bases(counts.withColumn("n", F.greatest(F.col("records") - 1, F.lit(0))), ["run_id"], ["file_path"], "n")
    in_run = stage(in_run.select("run_id", "file_path", F.col("base").alias("before"), "n"), "file-bases")
    totals = in_run.groupBy("run_id").agg(F.sum("n").alias("total"))
    bases = block_bases(plain_blocks, ["run_id", "file_path"], ["block_start"], "n").drop("n")
    bases = stage(bases.join(in_run.drop("n"), ["run_id", "file_path"]), "block-bases")
    number = F.col("base") + F.col("pos") - F.col("first") + 1

    def numbered(records: DataFrame, record: Column) -> DataFrame:
        row_number = (F.col("before") + F.col("number") - 1).alias("row_number")
        return records.filter("number > 1").select("run_id", "file_path", row_number, split_cells(record, width).alias("cells"))

    rows = numbered(lines.select(*_BLOCK, "pos", "line").join(bases, list(_BLOCK)).withColumn("number", number), body)
    if spanning is not None:
        rows = rows.unionByName(numbered(spanning.join(in_run.drop("n"), ["run_id", "file_path"]), F.col("record")))
    # an empty file has no first line: give it an empty header so that it still gets a verdict
    headers = (
        files.select("run_id", "file_path")
        .join(headers, ["run_id", "file_path"], "left")
        .withColumn("header", F.coalesce("header", F.array().cast("array<string>")))
    )
    return Landed(rows, headers, sizes(files), totals)


def _quoted_commas(line: Column) -> Column:
    """Commas inside quoted cells: those that disappear when quoted cells are blanked out."""
    outside = F.regexp_replace(line, r'"(?:[^"]++|"")*+"', "")
    return (F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))) - (
        F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    )


def _after(entry: int, flips: Column, last: Column) -> Column:
    """State after some lines or splits, given the state before the first: what the last one that fixes the state says, or
    the entry, turned as often as the state was turned since."""
    turned = F.when(last.isNull(), F.lit(entry) + flips).otherwise(last["state"] + flips - last["flips"])
    return turned % 2


def _states(rows: DataFrame, window, outside: Column, inside: Column, names: tuple[str, str, str, str]) -> DataFrame:
    """States before and after each row, for both states before the first row of its window.

    ``outside`` and ``inside`` are the states (0 outside a quoted cell, 1 inside) after the row for the two before it.
    """
    up_to = window.rowsBetween(Window.unboundedPreceding, 0)
    flips = F.sum(((outside == 1) & (inside == 0)).cast("int")).over(up_to)
    rows = rows.withColumn("_flips", flips)
    fixes = F.when(outside == inside, F.struct(outside.alias("state"), F.col("_flips").alias("flips")))
    rows = rows.withColumn("_last", F.last(fixes, ignorenulls=True).over(up_to))
    rows = rows.withColumns({names[2 + e]: _after(e, F.col("_flips"), F.col("_last")) for e in (0, 1)}).drop("_flips", "_last")
    return rows.withColumns({names[e]: F.lag(names[2 + e], 1, e).over(window) for e in (0, 1)})


def _stitched(lines: DataFrame, broken: DataFrame) -> DataFrame:
    """Records of the given files: run_id, file_path, number (the header is 1) and record.

    One shuffle brings the lines of each split together, however many splits a file has; of a file as a whole only one
    row per split meets. Blank lines count only inside quoted cells; a lone carriage return ends a record as well.
    """
    line = F.col("line")
    pieces = lines.select(*_BLOCK, "pos", "line").join(broken, ["run_id", "file_path"])
    cut = F.when(F.instr(_body(line), "\r") > 0, F.split(line, r"\r(?!\z)", -1)).otherwise(F.array(line))
    pieces = pieces.select(*_BLOCK, "pos", F.posexplode(cut).alias("sub", "line"))
    window = Window.partitionBy(*_BLOCK).orderBy("pos", "sub")
    before, after = ("before0", "before1"), ("after0", "after1")
    outside, inside = [_leaves_open(line, i).cast("int") for i in (False, True)]
    pieces = pieces.withColumns({"_outside": outside, "_inside": inside})
    pieces = _states(pieces, window, F.col("_outside"), F.col("_inside"), before + after).drop("_outside", "_inside")
    starts = {f"starts{e}": F.sum(((F.col(before[e]) == 0) & (_body(line) != "")).cast("int")).over(window) for e in (0, 1)}
    pieces = stage(pieces.withColumns(starts), "line-states")

    at_end = F.max_by(F.struct(*after, "starts0", "starts1"), F.struct("pos", "sub")).alias("end")
    ends = pieces.groupBy(*_BLOCK).agg(at_end).select(*_BLOCK, "end.*")
    splits = Window.partitionBy("run_id", "file_path").orderBy("block_start")
    ends = _states(ends, splits, F.col("after0"), F.col("after1"), ("entry", "_1", "_2", "_3"))
    ends = ends.withColumn("n", F.when(F.col("entry") == 0, F.col("starts0")).otherwise(F.col("starts1")))
    bases = stage(block_bases(ends.select(*_BLOCK, "entry", "n"), ["run_id", "file_path"], ["block_start"], "n").drop("n"), "split-bases")

    def chosen(names: tuple[str, str]) -> Column:
        return F.when(F.col("entry") == 0, F.col(names[0])).otherwise(F.col(names[1]))

    known = pieces.join(bases, list(_BLOCK)).select(
        *_BLOCK, "pos", "sub", "line",
        chosen(before).alias("before"), chosen(after).alias("after"), (F.col("base") + chosen(("starts0", "starts1"))).alias("number"),
    )
    known = known.filter((F.col("before") == 1) | (_body(line) != ""))
    alone = (F.col("before") == 0) & (F.col("after") == 0)
    # lines of a record in order, each after the break that parts it from the line before
    part = F.struct("block_start", "pos", "sub", F.concat(F.when(F.col("sub") > 0, F.lit("\r")).otherwise(F.lit("\n")), line).alias("text"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"]), "")
    spanning = known.filter(~alone).groupBy("run_id", "file_path", "number").agg(F.substr(joined, F.lit(2)).alias("line"))
    records = known.filter(alone).select("run_id", "file_path", "number", "line").unionByName(spanning)
    return records.select("run_id", "file_path", "number", _body(line).alias("record"))
