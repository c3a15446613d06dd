"""Records that span several pieces of a splittable text file.

The text source cuts files into byte ranges and rows (``pieces``); what a piece
means may depend on all pieces before it: whether it begins inside a quoted
value, or how deep it lies in a document.  Both are running sums, taken in two
steps: inside each byte range (a window over one range, so no more rows than a
range holds), and over the ranges' totals (a row per range).  No task sees a
whole file and no row holds more than a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.session import materialize

PLACE = ["file", "range_start", "nth"]


def pieces(spark: SparkSession, path: str, separator: str, above: int = -1) -> DataFrame:
    """file, file_size, range_start, nth, value: the pieces between separators of every file of more than ``above`` bytes.

    ``nth`` grows with the place inside a byte range.
    """
    return (spark.read.option("lineSep", separator).text(path).where(F.col("_metadata.file_size") > above)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
                    F.col("_metadata.file_block_start").alias("range_start"),
                    F.monotonically_increasing_id().alias("nth"), "value"))


def lines(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """The pieces of ``path`` by line, whole whatever characters they hold; ``header``: without each file's first."""
    # "\n" alone is the separator, so that a quoted value keeps its carriage returns
    all_lines = pieces(spark, path, "\n")
    if not header:
        return all_lines
    first = (all_lines.where(F.col("range_start") == 0).groupBy(F.col("file").alias("f"))
             .agg(F.min("nth").alias("first")))
    same = (all_lines["file"] == first["f"]) & (all_lines["range_start"] == 0) & (all_lines["nth"] == first["first"])
    return all_lines.join(first, same, "left_anti")


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _inside(amount: Column) -> Column:
    """Sum over the earlier pieces of the same byte range."""
    w = Window.partitionBy("file", "range_start").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(w), F.lit(0))


def _earlier(amount: Column) -> Column:
    """On a row per range: sum over the earlier ranges of the file."""
    w = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(w), F.lit(0))


def _of_file(amount: Column) -> Column:
    return F.sum(amount).over(Window.partitionBy("file"))


def joined(df: DataFrame, record: str, separator: str, *aggregates: Column) -> DataFrame:
    """One row per record: its pieces in order as ``value``, and ``aggregates``; a partition's rows in file order."""
    ordered = F.array_sort(F.collect_list(F.struct("range_start", "nth", "value")))
    return (df.groupBy("file", record).agg(ordered.alias("_pieces"), *aggregates)
            .withColumn("value", F.array_join(F.transform("_pieces", lambda p: p["value"]), separator))
            .drop("_pieces").sortWithinPartitions("file", record))


def quoted_records(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """``line``: CSV records whose quoted fields may hold newlines, from splittable files.

    A record ends at the first newline that an even number of quotes precedes.
    The header, too, may span lines.  A file that ends inside a quoted field
    gives a last record with an open quote, which the caller's shape check
    finds.
    """
    quotes = _count(F.col("value"), '"')
    # what a line is if its range begins outside (0) or inside (1) a quoted field
    cut = (pieces(spark, path, "\n").withColumn("quotes", quotes)
           .withColumn("start0", (_inside(F.col("quotes")) % 2 == 0).cast("int")).withColumn("start1", 1 - F.col("start0"))
           .withColumns({"before0": _inside(F.col("start0")), "before1": _inside(F.col("start1"))}))
    ranges = (cut.groupBy("file", "range_start").agg(*[F.sum(c).alias(c) for c in ("quotes", "start0", "start1")])
              .withColumn("quoted", _earlier(F.col("quotes")) % 2 == 1)
              .select("file", "range_start", "quoted",
                      _earlier(F.when(F.col("quoted"), F.col("start1")).otherwise(F.col("start0"))).alias("first")))
    own = (F.when(F.col("quoted"), F.col("before1") + F.col("start1")).otherwise(F.col("before0") + F.col("start0")))
    numbered = (cut.select(*PLACE, "value", "before0", "before1", "start0", "start1").join(ranges, ["file", "range_start"])
                .select(*PLACE, "value", (F.col("first") + own).alias("record")))
    whole = joined(numbered, "record", "\n")
    if header:
        whole = whole.where(F.col("record") > 1)
    return whole.select(F.rtrim("value", F.lit("\r")).alias("line"))


# -- one JSON document ------------------------------------------------------------

_TEXT = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_STRING = f'"{_TEXT}"'
_SCALAR = r'[^\s"{}\[\],:]++'
_FLAT = rf'(?:{_STRING}|{_SCALAR}|\[[^\[\]{{}}"]*+(?:{_STRING}[^\[\]{{}}"]*+)*+\])'
#: What may stand before the first member that holds objects (or, of an array, arrays); its key; its brackets.
_OPENER = (rf'(?s)^((?:[\s,{{\]]++|{_STRING}\s*+:\s*+{_FLAT}\s*+(?=[,}}\]])|{_STRING}(?!\s*+:)|{_SCALAR})*+)'
           rf'({_STRING})\s*+:\s*+(\{{|\[\s*+\[?)')
#: The rest of a string that began in an earlier piece.
_TAIL = f'(?s)^{_TEXT}"'


def _bare(piece: Column) -> Column:
    """``piece`` without its strings, an open one at its end included."""
    return F.regexp_replace(piece, f'(?s){_STRING}|"{_TEXT}$', "")


def _depth(bare: str) -> Column:
    """Brackets that a piece without strings opens less those it closes."""
    c = F.col(bare)
    return _count(c, "{") + _count(c, "[") - _count(c, "}") - _count(c, "]")


def array_elements(spark: SparkSession, path: str, member: str, above: int = -1) -> DataFrame:
    """``element``: the JSON text of every object in the array ``member`` of the one document of each file that has
    more than ``above`` bytes.

    Files are cut at every closing brace.  The quotes before a piece tell
    whether it begins inside a string (a brace may be part of a text), the
    brackets before it how deep it lies; an element closes where the depth is
    back at that of the array.  Members beside the array are skipped.  A
    truncated document, an element that is no object, and members that can't
    be told apart (an array of arrays beside the wanted one) stop the load.
    """
    # What a piece is if its range begins outside (0) or inside (1) a string.  An escape never crosses a cut: "\\}" is
    # no JSON escape.
    cut = (pieces(spark, path, "}", above).withColumn("value", F.concat("value", F.lit("}")))
           .withColumns({"plain": F.regexp_replace("value", r"(?s)\\.", ""), "bare_out": _bare(F.col("value")),
                         "bare_within": _bare(F.concat(F.lit('"'), "value"))})
           .withColumns({"quotes": _count(F.col("plain"), '"'), "out": _depth("bare_out"),
                         "within": _depth("bare_within")})
           .select(*PLACE, "file_size", "value", "quotes", "out", "within")
           .withColumn("odd", _inside(F.col("quotes")) % 2 == 1)
           .withColumns({"gain0": F.when(F.col("odd"), F.col("within")).otherwise(F.col("out")),
                         "gain1": F.when(F.col("odd"), F.col("out")).otherwise(F.col("within"))})
           .withColumns({"depth0": _inside(F.col("gain0")), "depth1": _inside(F.col("gain1"))}))
    gain = F.when(F.col("in_text"), F.col("gain1")).otherwise(F.col("gain0"))
    ranges = (cut.groupBy("file", "range_start")
              .agg(*[F.sum(c).alias(c) for c in ("quotes", "gain0", "gain1")],
                   F.sum(F.octet_length("value")).alias("bytes"), F.max("file_size").alias("file_size"))
              .withColumn("in_text", _earlier(F.col("quotes")) % 2 == 1).withColumn("gain", gain))
    # the last piece of a file has no brace behind it unless the file ends there
    missing = _of_file(F.col("bytes")) - F.col("file_size")
    sound = (_of_file(F.col("gain")) + missing == 0) & (_of_file(F.col("quotes")) % 2 == 0)
    ranges = ranges.select(F.col("file").alias("f"), F.col("range_start").alias("r"), "in_text",
                           _earlier(F.col("gain")).alias("start_depth"), sound.alias("sound"))
    odd = F.col("odd") != F.col("in_text")
    placed = (cut.join(ranges, (F.col("file") == F.col("f")) & (F.col("range_start") == F.col("r")))
              .select(*PLACE, F.when(F.col("sound"), F.col("value")).otherwise(
                          F.raise_error(F.concat(F.lit("malformed or truncated document "), "file"))).alias("value"),
                      odd.alias("in_text"), gain.alias("gain"),
                      (F.col("start_depth") + F.when(F.col("in_text"), F.col("depth1")).otherwise(F.col("depth0")))
                      .alias("depth")))
    # a piece from outside the elements of an array may lead into a member of the document
    body = F.when(F.col("in_text"), F.regexp_replace("value", _TAIL, "")).otherwise(F.col("value"))
    opened = (placed.withColumn("body", F.when(F.col("depth") <= 2, body).otherwise(""))
              .withColumns({"prefix": F.regexp_extract("body", _OPENER, 1), "key": F.regexp_extract("body", _OPENER, 2),
                            "brackets": F.regexp_extract("body", _OPENER, 3)})
              .withColumn("bare", _bare(F.col("prefix"))))
    at_root = (F.col("key") != "") & (F.col("depth") + _depth("bare") == 1)
    arrays = F.regexp_replace("brackets", r"\s", "")
    begins = F.when(at_root & (arrays == "[["), F.raise_error(F.lit("an array of arrays beside the wanted member"))
                    ).otherwise(at_root & (F.col("key") == f'"{member}"') & (arrays == "["))
    # the wanted array ends where a piece at its depth goes on behind its bracket
    leaves = ~F.col("in_text") & (F.col("depth") == 2) & F.col("value").rlike(rf'(?s)^(?:[^{{}}"\]]|{_STRING})*+\]')
    flagged = (opened.withColumns({"begins": begins.cast("int"), "leaves": leaves.cast("int"),
                                   "closes": (F.col("depth") + F.col("gain") == 2).cast("int")})
               .select(*PLACE, "begins", "leaves", "closes",
                       F.when(F.col("begins") == 1, F.regexp_replace("body", _OPENER, ""))
                       .otherwise(F.col("value")).alias("value")))
    marked = materialize(flagged, "document-pieces")
    place = F.struct("range_start", "nth")
    totals = (marked.groupBy("file", "range_start").agg(F.sum("closes").alias("closes"))
              .select(F.col("file").alias("f"), F.col("range_start").alias("r"),
                      _earlier(F.col("closes")).alias("closed_earlier")))
    ends = (marked.where("begins = 1").groupBy(F.col("file").alias("b")).agg(F.min(place).alias("begin")))
    leaving = (marked.where("leaves = 1").join(ends, F.col("file") == F.col("b")).where(place > F.col("begin"))
               .groupBy("b").agg(F.min(F.struct("range_start", "nth", "value")).alias("end")))
    spans = (ends.join(leaving.withColumnRenamed("b", "e"), F.col("b") == F.col("e"), "left")
             .select("b", "begin", "end"))
    last = F.struct(F.col("end.range_start"), F.col("end.nth"))
    scalars = F.col("end.value").isNotNull() & ~F.col("end.value").rlike(r"^\s*+\]")
    inside = (place >= F.col("begin")) & F.when(F.col("end").isNull(), True).when(
        scalars, F.raise_error(F.concat(F.lit("array element is no object: "), F.left("end.value", F.lit(80))))
    ).otherwise(place < last)
    numbered = (marked.withColumn("closed_before", _inside(F.col("closes")))
                .join(totals, (F.col("file") == F.col("f")) & (F.col("range_start") == F.col("r")))
                .join(spans, F.col("file") == F.col("b")).where(inside)
                .select(*PLACE, "closes", "value", (F.col("closed_earlier") + F.col("closed_before")).alias("record")))
    whole = joined(numbered, "record", "", F.max("closes").alias("closed")).where("closed = 1")
    text = F.col("text")
    bad = F.raise_error(F.concat(F.lit("array element is no object: "), F.left(text, F.lit(80))))
    return (whole.select(F.regexp_replace("value", r"^[\s,]++", "").alias("text"))
            .select(F.when(text.startswith("{"), text).otherwise(bad).alias("element")))


def small_array_elements(spark: SparkSession, path: str, member: str, most: int) -> DataFrame:
    """The same for files of at most ``most`` bytes, each read whole by one task: no shuffle, and the document is
    parsed once.  What stops the load there stops it here.  A compressed file counts by its compressed size."""
    files = (spark.read.text(path, wholetext=True)
             .where((F.col("_metadata.file_size") <= most) & (F.trim("value") != ""))
             .select(F.col("_metadata.file_path").alias("file"), "value")
             .withColumn("bare", F.regexp_replace("value", rf'(?s){_STRING}|[^"{{}}\[\]]++', "")))  # brackets only
    sound = (_depth("bare") == 0) & (_count(F.col("bare"), '"') == 0)
    members = F.from_json(F.when(sound, F.col("value")).otherwise(F.raise_error(
        F.concat(F.lit("malformed or truncated document "), "file"))), "map<string,string>", {"mode": "FAILFAST"})
    beside = F.exists(F.map_values(F.map_filter("members", lambda k, _: k != member)), lambda v: v.rlike(r"^\[\s*+\["))
    wanted = (F.when(beside & F.col("bare").contains("[["),
                     F.raise_error(F.lit("an array of arrays beside the wanted member")))
              .when(F.col("wanted").startswith("["), F.from_json("wanted", "array<string>", {"mode": "FAILFAST"})))
    text = F.col("text")
    bad = F.raise_error(F.concat(F.lit("array element is no object: "), F.coalesce(F.left(text, F.lit(80)), F.lit("null"))))
    return (files.withColumn("members", members).withColumn("wanted", F.col("members")[member])
            .select(F.explode(wanted).alias("text"))
            .select(F.when(text.startswith("{"), text).otherwise(bad).alias("element")))
