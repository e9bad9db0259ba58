"""Records that span several lines of text files: nested JSON state and device trees.

The lines of a record belong together by their place in the file, which a scan in
line splits would lose. So the text source is told what ends a record: it then cuts files,
also those read in several splits, between records, and a record arrives whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OBJECT_END = "\n}\n"  # an object's last line is a brace of its own


def read_records(spark: SparkSession, path: str, end: str) -> DataFrame:
    """``(file, record)``: what stands between two ``end`` in the files below ``path``."""
    rows = spark.read.option("lineSep", end).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))


def json_objects(records: DataFrame, text: str = "record") -> DataFrame:
    """One row for each pretty-printed object: its ``text`` and its ``value`` as VARIANT, null if it
    is broken.

    An object begins with a brace at the start of a line. One that is cut off before its last
    line runs into the next in ``records``; the two come apart again there, so a
    broken object costs no other. Text outside objects is dropped; other columns stay."""
    pieces = F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=\{)")
    rows = records.select("*", F.posexplode(pieces).alias("_tv_n", "_tv_piece"), F.size(pieces).alias("_tv_of"))
    rows = rows.where(F.col("_tv_piece").startswith("{"))
    # the reader took the last brace of what it cut, but for the last object of a file without a line end
    last = (F.col("_tv_n") == F.col("_tv_of") - 1) & ~F.col("_tv_piece").rlike(r"\n\}\s*$")
    whole = F.when(last, F.concat("_tv_piece", F.lit("\n}"))).otherwise(F.col("_tv_piece"))
    keep = [c for c in records.columns if c != text]
    return rows.select(*keep, whole.alias("text"), F.try_parse_json(whole).alias("value"))


def extract_nested(objects: DataFrame, fields: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Columns cut out of ``value`` by path and type, ``{name: ("$.a.b", "string")}``; null where the
    object is broken, has no such path, or holds something that is not of the type."""
    return objects.select(*keep, *[F.try_variant_get("value", path, kind).alias(name) for name, (path, kind) in fields.items()])


def explode_nested(objects: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each element of the array at ``path``: ``(keep.., pos, value)``; broken objects and
    those without such an array give none."""
    items = F.try_variant_get("value", path, "array<variant>")
    return objects.select(*keep, F.posexplode(items).alias("pos", "value"))


# ------------------------------------------------------------------ device trees

BRANCH = r"^((?:[│ |] )*)([├└|`][─-])?"  # a child's line begins with bars and one branch mark


def _column_spans(header: Column) -> Column:
    """Start (from 1) and end of each column of a header line, by name: numbers stand below the
    end of their heading and texts below its start, so a column reaches from the end
    of the heading before to the start of the one after."""
    names = F.split(F.trim(header), r"\s+")
    padded = F.concat(F.lit(" "), header, F.lit(" "))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.named_struct(
        F.lit("start"), F.instr(padded, F.concat(F.lit(" "), n, F.lit(" "))), F.lit("size"), F.length(n))))


def device_lines(listings: DataFrame, keep: Sequence[str], text: str = "record") -> DataFrame:
    """The lines of device listings, one row each: ``(keep.., line_no, cells, depth)``.

    ``cells`` maps each heading to what stands below it. A heading claims the words that
    overlap its place; a line's words are told from one another by blanks, and an empty cell
    takes no word of its neighbours. ``depth`` counts the levels of the branch marks. Lines before
    the header (``NAME`` first) are dropped; a listing without a header gives none."""
    lines = F.split(F.translate(F.col(text), "\t", " "), r"\r?\n")
    rows = listings.select(*keep, lines.alias("_tv_lines"))
    at = F.array_position(F.transform("_tv_lines", lambda x: x.rlike(r"^NAME\s")), F.lit(True)).cast("int")
    rows = rows.withColumn("_tv_at", at).where("_tv_at > 0")
    header = F.element_at("_tv_lines", F.col("_tv_at"))
    body = F.slice("_tv_lines", F.col("_tv_at") + 1, F.size("_tv_lines"))
    # what all lines of a listing share is made before they part
    rows = rows.select(*keep, header.alias("_tv_header"), body.alias("_tv_body"))
    rows = rows.select(*keep, _column_spans(F.col("_tv_header")).alias("_tv_spans"), "_tv_body")
    rows = rows.select(*keep, "_tv_spans", F.posexplode("_tv_body").alias("line_no", "_tv_line"))
    rows = rows.where(F.trim("_tv_line") != "")
    prefix = F.regexp_extract("_tv_line", BRANCH, 0)
    bare = F.regexp_replace("_tv_line", BRANCH, "")
    depth = F.floor(F.length(prefix) / 2).cast("int")
    name = F.regexp_extract(bare, r"^\S+", 0)
    # blanks in place of the marks and the name keep the columns where they are
    head = F.length(prefix) + F.length(name)
    rest = F.concat(F.repeat(F.lit(" "), head), F.substr("_tv_line", head + 1))
    rows = rows.select(*keep, "line_no", "_tv_spans", name.alias("_tv_name"), rest.alias("_tv_rest"), depth.alias("depth"))

    def cell(heading: Column, span: Column) -> Column:
        """The first word that stands below some of the heading."""
        below = F.substr("_tv_rest", span["start"])
        found = F.ltrim(below)
        before = F.substring_index(F.substr("_tv_rest", F.lit(1), span["start"] - 1), " ", -1)
        word = F.concat(F.when(below.startswith(" "), F.lit("")).otherwise(before), F.substring_index(found, " ", 1))
        reaches = (F.length(found) > 0) & (F.length(below) - F.length(found) < span["size"])
        return F.when(heading == "NAME", F.col("_tv_name")).when(reaches, word)

    cells = F.transform_values("_tv_spans", cell)
    return rows.select(*keep, "line_no", cells.alias("cells"), "depth")


def device_tree(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    """``lines`` with ``parent``: the name in the nearest line above that is one level up, within
    ``by``. An ordered window carries names down: each line is a possible parent on the level below
    and asks on its own, so the window never looks at a whole listing at once."""
    name = F.col("cells")["NAME"]
    row = F.struct("*")
    ask = lines.select(*by, F.col("depth").alias("_tv_level"), "line_no", F.lit(0).alias("_tv_own"),
                       F.lit(None).cast("string").alias("_tv_name"), row.alias("_tv_row"))
    offer = lines.select(*by, (F.col("depth") + 1).alias("_tv_level"), "line_no", F.lit(1).alias("_tv_own"),
                         name.alias("_tv_name"), F.lit(None).cast(ask.schema["_tv_row"].dataType).alias("_tv_row"))
    w = Window.partitionBy(*by, "_tv_level").orderBy("line_no", "_tv_own").rowsBetween(Window.unboundedPreceding, -1)
    both = ask.unionByName(offer).withColumn("parent", F.last("_tv_name", ignorenulls=True).over(w))
    return both.where("_tv_own = 0").select("_tv_row.*", F.when(F.col("_tv_level") > 0, F.col("parent")).alias("parent"))


def parse_device_tree(listings: DataFrame, by: Sequence[str], text: str = "record") -> DataFrame:
    """Device listings as rows ``(by.., line_no, name, major, minor, size, mountpoint, parent)``."""
    tree = device_tree(device_lines(listings, by, text), by)
    cell = F.col("cells")
    numbers = F.split(cell["MAJ:MIN"], ":")
    return tree.select(*by, "line_no", cell["NAME"].alias("name"), F.get(numbers, 0).try_cast("int").alias("major"),
                       F.get(numbers, 1).try_cast("int").alias("minor"), cell["SIZE"].alias("size"),
                       cell["MOUNTPOINT"].alias("mountpoint"), "parent")
