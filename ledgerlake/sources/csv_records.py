"""Records of quoted CSV in parallel: a file is split like any text, whatever its quoted fields hold.

Spark splits the files into blocks of lines. A line's quotes are summarised as what they do to "inside a quoted field":
whether the line ends inside one if it starts outside, and if it starts inside. Such summaries compose in any grouping,
so those of a block are composed by a window over the block, those of a file by a window over its blocks, and the result
gives every line's true state. Only lines with quotes that matter take part (an id and two flags each); the text of a
line moves only if its record has several lines, or, where there are many such records, once. Fields are parsed by
Spark's ``from_csv``.

The lines are written once to the shared checkpoint folder, so that line numbers stay the same whatever is read again.
Where no line leaves a quoted field open, each line is a record: then no line needs a number and none is written.
Lines end in LF or CRLF; a file's first line says which, and a CRLF file's quoted line ends become LF, as Spark's
reader has it. A quote opens a field only at its start; a doubled quote inside a quoted field is a quote; text after a
closing quote makes the field a plain one up to the next delimiter.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import col, quote
from ledgerlake.session import ensure_checkpoint_dir

#: Lines of records with several lines are looked up by broadcast up to this number, else by a shuffle.
MAX_BROADCAST_LINES = 1 << 19
#: Different headers that one input may have.
MAX_HEADERS = 100
CORRUPT = "_corrupt_record"


class Records(NamedTuple):
    """``rows``: file, record (a number; of several lines, the first one's), text; with the header records. ``files``: file, record (of the
    header), header. Both are lazy reads, of written tables or of the files."""
    rows: DataFrame
    files: DataFrame


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ends_inside(value: str, delimiter: str, inside: bool) -> Column:
    """Whether a line that starts inside or outside a quoted field ends inside one.

    States: 0 outside, at a field's start; 1 outside, in a field; 2 inside; 3 inside, after a quote that closes the
    field or begins a doubled one. The line is taken piece by piece between its quotes.
    """
    d = "'" + delimiter.replace("\\", "\\\\").replace("'", "\\'") + "'"
    first = "2" if inside else f"IF(pieces[0] = '' OR endswith(pieces[0], {d}), 0, 1)"
    after_quote = "CASE s WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 2 END"
    step = (f"CASE WHEN s IN (0, 3) THEN 2 WHEN t = '' THEN {after_quote} WHEN endswith(t, {d}) THEN 0 ELSE 1 END")
    rest = "slice(pieces, 2, size(pieces))"
    state = f"aggregate({rest}, {first}, (s, t) -> {step})".replace("pieces", f"split({value}, '\"', -1)")
    return F.expr(f"IF(contains({value}, '\"'), {state} = 2, {str(inside).lower()})")


def _compose(by: list[str], order: str, opened: str, kept: str) -> tuple[Column, Column]:
    """What the rows up to each do together: whether they end inside from outside, and from inside.

    ``opened`` and ``kept`` name the two flags of a row. A row whose flags are equal forgets what was before; one that
    has both turned swaps the state.
    """
    rows = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = F.sum(F.when(F.col(opened) & ~F.col(kept), 1).otherwise(0)).over(rows)
    sets = F.when(F.col(opened) == F.col(kept), F.struct(F.col(order), F.col(opened).alias("to"), swaps.alias("swaps")))
    last = F.max(sets).over(rows)  # the last row that sets the state
    odd = (swaps - F.coalesce(last["swaps"], F.lit(0))) % 2 == 1
    from_outside, from_inside = (F.coalesce(last["to"], F.lit(x)) != odd for x in (False, True))
    return from_outside, from_inside


def read_lines(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """(file, block, line, value, opened, kept): the written lines, numbered in order inside a block, with their
    summaries: whether one ends inside a quoted field when it starts outside, or inside."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    return _written(lines.select("*", _ends_inside("value", delimiter, False).alias("opened"),
                                 _ends_inside("value", delimiter, True).alias("kept")), "csv-lines")


class States(NamedTuple):
    """``known``: the lines whose quotes matter, with ``starts`` and ``ends`` (whether inside), ``opening`` and
    ``record``. ``blocks``: a row a block with ``inside`` (at its start) and, if so, the record that is ``open`` there
    and the block ``home`` of that record's first line."""
    known: DataFrame
    blocks: DataFrame


def line_states(lines: DataFrame) -> States:
    """The states at the lines with quotes and at the starts of blocks."""
    events = lines.filter("opened OR NOT kept").select("file", "block", "line", "opened", "kept")
    inside, still = _compose(["file", "block"], "line", "opened", "kept")
    events = _written(events.select("*", inside.alias("to_here"), still.alias("to_here_inside")), "csv-events")
    # what a whole block does, and from that the state at each block's start
    of_block = ["file", "block"]
    whole = events.groupBy(*of_block).agg(F.max_by("to_here", "line").alias("opened"),
                                          F.max_by("to_here_inside", "line").alias("kept"))
    spans = lines.groupBy(*of_block).agg(F.min("line").alias("first"), F.max("line").alias("last"))
    blocks = spans.join(whole, of_block, "left").select(
        "file", "block", "first", "last", F.coalesce("opened", F.lit(False)).alias("opened"),
        F.coalesce("kept", F.lit(True)).alias("kept"))
    in_file = Window.partitionBy("file").orderBy("block")
    after, _ = _compose(["file"], "block", "opened", "kept")
    blocks = blocks.select("*", after.alias("after")).select(
        "*", F.coalesce(F.lag("after").over(in_file), F.lit(False)).alias("inside"))
    blocks = _written(blocks.select("file", "block", "first", "last", "inside"), "csv-blocks")

    in_block = Window.partitionBy(*of_block).orderBy("line")
    known = events.join(blocks.select("file", "block", "last", "inside"), of_block)
    known = known.withColumn("ends", F.when(F.col("inside"), F.col("to_here_inside")).otherwise(F.col("to_here")))
    known = known.withColumn("starts", F.coalesce(F.lag("ends").over(in_block), F.col("inside")))
    known = known.withColumn("opening", F.when(~F.col("starts") & F.col("ends"), F.col("line")))
    known = known.withColumn("record", F.last("opening", True).over(
        in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    known = known.withColumn("upto", F.coalesce(F.lead("line").over(in_block), F.col("last")))
    known = _written(known, "csv-states")
    # the record that is open at a block's start was opened in a block before
    opened = known.groupBy(*of_block).agg(F.max("opening").alias("opening"), F.min("line").alias("event"),
                                          F.min(F.when(~F.col("ends"), F.col("line"))).alias("outside"))
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.join(opened, of_block, "left").select(
        "*", F.last("opening", True).over(before).alias("open"),
        F.last(F.when(F.col("opening").isNotNull(), F.col("block")), True).over(before).alias("home"))
    return States(known, _written(starts, "csv-starts"))


def continued(states: States) -> DataFrame:
    """(line, record): the lines of records with several lines, each with the number of its record's first line."""
    known, starts = states
    heads = starts.filter("inside").select(
        "open", F.explode(F.expr("sequence(first, coalesce(event, last))")).alias("line"))
    inner = known.filter("ends AND upto > line").join(starts.select("file", "block", "open"), ["file", "block"]).select(
        F.coalesce("record", "open").alias("open"), F.explode(F.expr("sequence(line + 1, upto)")).alias("line"))
    firsts = known.filter("opening IS NOT NULL").select(F.col("line").alias("open"), "line")
    return heads.unionByName(inner).unionByName(firsts).select("line", F.col("open").alias("record"))


def _joined_lines(lines: DataFrame, *by: str) -> DataFrame:
    """The text of each record from its lines."""
    return (lines.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("all"))
            .select("file", "record", F.array_join(F.col("all.value"), "\n").alias("value")))


def _all_records(lines: DataFrame, states: States) -> DataFrame:
    """(file, record, value): all records, with one shuffle of the lines.

    The lines that finish a record of a block before go to that record's block, its home. So each home starts outside
    of quotes, holds whole records, and its lines tell the records by themselves.
    """
    moved = F.broadcast(states.blocks.filter("inside").select(
        "file", "block", "home", F.coalesce("outside", "last").alias("upto")))  # at most a row a block
    homed = lines.join(moved, ["file", "block"], "left").select(
        "file", F.when(F.col("line") <= F.col("upto"), F.col("home")).otherwise(F.col("block")).alias("home"),
        F.struct("block", "line").alias("at"), "block", "line", "value", "opened", "kept")
    ends, _ = _compose(["file", "home"], "at", "opened", "kept")
    in_home = Window.partitionBy("file", "home").orderBy("at")
    first = ~F.coalesce(F.lag("ends").over(in_home), F.lit(False))
    told = homed.withColumn("ends", ends).withColumn("first", F.when(first, F.col("line"))).withColumn(
        "record", F.last("first", True).over(in_home.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return _joined_lines(told, "file", "home", "record")


def _without_cr(name: str) -> Column:
    return F.when(F.endswith(name, F.lit("\r")), F.expr(f"left({name}, length({name}) - 1)")).otherwise(F.col(name))


def _with_text(records: DataFrame, files: DataFrame) -> DataFrame:
    """``records`` (file, record, value) with their text, by the line ends of their ``files`` (file, crlf)."""
    text = F.when(F.col("crlf"), F.replace(_without_cr("value"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))
    return records.join(F.broadcast(files.select("file", "crlf")), "file").select(
        "file", "record", text.alias("text")).filter("text != ''")


def _header_text(text: str) -> Column:
    return F.regexp_replace(text, "^\\uFEFF", "")


def _line_records(spark: SparkSession, path: str, delimiter: str) -> Records | None:
    """The records of files in which no line opens a quoted field that it does not close, so that each line is one;
    None if there is such a line, or one that is as a header but is not the header.

    Lines then need no numbers: a header is told by its text, and nothing is written but a row a file. ``record`` is 0
    for a header, 1 for others.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    order = F.struct("block", "line")
    heads = _written(lines.withColumn("line", F.monotonically_increasing_id()).groupBy("file").agg(
        F.max(_ends_inside("value", delimiter, False)).alias("opened"),
        F.min_by("value", F.when(_without_cr("value") != "", order)).alias("head"),
        F.min_by(F.endswith("value", F.lit("\r")), order).alias("crlf")), "csv-heads")
    if heads.filter("opened").count():
        return None
    of_file = F.broadcast(heads.select("file", "head"))
    copies = lines.select("file", "value").join(of_file, "file").filter("value = head").groupBy("file").count()
    if copies.filter("count > 1").count():
        return None
    rows = lines.select("file", "value").join(of_file, "file").select(
        "file", F.when(F.col("value") == F.col("head"), 0).otherwise(1).alias("record"), "value")
    files = _with_text(heads.filter("head IS NOT NULL").select("file", F.lit(0).alias("record"), F.col("head").alias("value")),
                       heads)
    return Records(_with_text(rows, heads), files.select("file", "record", _header_text("text").alias("header")))


def csv_records(spark: SparkSession, path: str, delimiter: str = ",") -> Records:
    """The records of the CSV files under ``path``, read by as many tasks as they have blocks. Empty lines outside of
    quotes are no records."""
    if found := _line_records(spark, path, delimiter):
        return found
    lines = read_lines(spark, path, delimiter)
    states = line_states(lines)
    parts = continued(states)
    several = parts.count()
    if several > MAX_BROADCAST_LINES:
        found = _all_records(lines, states)
    elif several:
        parts = _written(parts, "csv-continued")
        all_lines = lines.join(F.broadcast(parts), "line", "left")
        found = all_lines.filter("record IS NULL").select("file", F.col("line").alias("record"), "value").unionByName(
            _joined_lines(all_lines.filter("record IS NOT NULL"), "file", "record"))
    else:
        found = lines.select("file", F.col("line").alias("record"), "value")
    # one row a file, as the driver's own listing has: its line ends, and its first line that is not empty
    heads = lines.groupBy("file").agg(
        F.min(F.when(_without_cr("value") != "", F.struct("block", "line"))).alias("head"),
        F.min_by(F.endswith("value", F.lit("\r")), F.struct("block", "line")).alias("crlf"))
    heads = _written(heads.select("file", F.col("head.line").alias("head"), "crlf"), "csv-heads")
    # the lines of the headers are looked up by themselves, so that no other text moves for them
    of_head = _written(heads.filter("head IS NOT NULL").join(parts, F.col("head") == F.col("record"), "left").select(
        "file", F.col("head").alias("record"), F.coalesce("line", "head").alias("line")), "csv-head-lines")
    files = _with_text(_joined_lines(lines.drop("file").join(of_head, "line"), "file", "record"), heads).select(
        "file", "record", _header_text("text").alias("header"))
    return Records(_with_text(found, heads), _written(files, "csv-headers"))


def header_names(spark: SparkSession, header: str, options: dict[str, str]) -> list[str]:
    """The column names of a header record: an empty one is ``_c`` and its place, one that occurs again in any case of
    letters has its place added."""
    one = spark.range(1)
    width = len(T.DataType.fromDDL(one.select(F.schema_of_csv(F.lit(header), options)).first()[0]).fields)
    fields = ", ".join(f"_c{k} string" for k in range(width))
    given = list(one.select(F.from_csv(F.lit(header), fields, options).alias("x")).first()["x"])
    low = [(x or "").lower() for x in given]
    return [f"_c{k}" if not x else f"{x}{k}" if low.count(x.lower()) > 1 else x for k, x in enumerate(given)]


def check_names(path: str, found: list[str], wanted: list[str]) -> None:
    """Raises ``ValueError`` unless a header has exactly the wanted names, in any order."""
    missing, unknown = [n for n in wanted if n not in found], [n for n in found if n not in wanted]
    if missing or unknown:
        raise ValueError(f"{path}: a CSV header has {', '.join(found)}" + f"; missing: {', '.join(missing)}" * bool(missing)
                         + f"; unknown: {', '.join(unknown)}" * bool(unknown))


def read_csv(spark: SparkSession, path: str, *, schema: T.StructType | None = None, infer_schema: bool = True,
             delimiter: str = ",", reject: str | None = None) -> DataFrame:
    """The rows of quoted CSV files with a header, as Spark's multi-line reader gives them, read in parallel.

    Columns are found by the names in each file's header: files may have them in another order, other names raise
    ``ValueError``. ``schema`` asks for its columns and types by name; without it, types are inferred from all values
    (``infer_schema``) or are text. ``reject`` names a further column with the text of a record that has too few or too
    many fields or a value of another type, else null.
    """
    records = csv_records(spark, path, delimiter)
    options = {"escape": '"', "sep": delimiter, "multiLine": "true"}
    headers = [r["header"] for r in records.files.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"{path}: more than {MAX_HEADERS} different headers")
    if not headers:
        return spark.createDataFrame([], schema or T.StructType([]))
    named = {h: header_names(spark, h, options) for h in headers}
    names = named[min(headers)] if schema is None else schema.fieldNames()
    for own in named.values():
        check_names(path, own, names)
    known = F.broadcast(records.files.select("file", F.col("record").alias("head"), "header"))
    body = records.rows.join(known, "file").filter("record != head")
    corrupt = reject or CORRUPT
    parts = []
    for h, own in named.items():
        types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
        fields = [T.StructField(n, types.get(n, T.StringType())) for n in own]
        if reject:
            fields.append(T.StructField(corrupt, T.StringType()))
        parsed = F.from_csv("text", ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in fields),
                            options | {"columnNameOfCorruptRecord": corrupt})
        part = body.filter(F.col("header") == F.lit(h)).select(parsed.alias("x"))
        parts.append(part.select(*[F.col("x").getField(n).alias(n) for n in names + [corrupt] * bool(reject)]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out if schema is not None or not infer_schema else _inferred(_written(out, "csv-text"), reject)


# How numbers, dates and times are written, for the inference of types.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^\s*(NaN|-?Inf|[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?)\s*$"
DATE, TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9:]+)?$"


def _inferred(df: DataFrame, leave: str | None = None) -> DataFrame:
    """``df`` (text) with the narrowest type of int, bigint, decimal, double, date, timestamp and boolean that all
    values of a column have; one pass over all values."""
    names = [n for n in df.columns if n != leave]

    def fits(c: Column, kind: str, pattern: str) -> Column:
        return F.coalesce(F.regexp_like(c, F.lit(pattern)) & c.try_cast(kind).isNotNull(), F.lit(False))

    tests = [("int", "int", WHOLE), ("bigint", "bigint", WHOLE), ("double", "double", NUMBER), ("date", "date", DATE),
             ("timestamp", "timestamp", TIME), ("boolean", "boolean", "^(?i)(true|false)$")]
    checks = [F.struct(F.count(col(n)).alias("all"), F.max(F.when(fits(col(n), "decimal(38,0)", WHOLE),
                                                                  F.length(col(n)))).alias("digits"),
                       F.count_if(fits(col(n), "decimal(38,0)", WHOLE)).alias("whole"),
                       F.count_if(fits(col(n), "date", DATE) | fits(col(n), "timestamp", TIME)).alias("moment"),
                       *[F.count_if(fits(col(n), kind, pattern)).alias(label) for label, kind, pattern in tests])
              .alias(f"c{k}") for k, n in enumerate(names)]
    found = df.agg(*checks).first()

    def kind(r) -> str:
        if not r["all"]:
            return "string"
        for label in ("int", "bigint"):
            if r[label] == r["all"]:
                return label
        if r["whole"] == r["all"]:
            return f"decimal({min(38, r['digits'])},0)"
        return next((label for label, _, _ in tests[2:] if r[label] == r["all"]),
                    "timestamp" if r["moment"] == r["all"] else "string")

    kinds = {n: kind(found[f"c{k}"]) for k, n in enumerate(names)}
    return df.select(*[col(n).cast(kinds[n]).alias(n) if n in kinds and kinds[n] != "string" else col(n)
                       for n in df.columns])
