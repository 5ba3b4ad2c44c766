"""Delivery file (S4, S5): parameter preamble, header and CSV rows.

The file is written by the executors as ordered text part files: the three
preamble lines sort first, then the data rows in a stable order, and the
output is range-partitioned so that the part files, concatenated in name
order, form the file (no single task or the driver ever holds all rows).  A
delivery is written beside the one before and takes its place when it is whole.
Lines end with CRLF and fields are quoted like Python's ``csv`` module
(minimal quoting, doubled quotes, NULL as an empty field).

Numbers are written with all digits of the computed double, in the shortest
form that reads back as the same value (``0.5``, ``30.0``,
``0.3333333333333333``); an exponent is written out as zeros.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow.sources.versions import Folder

# The parameter lines and column labels of the delivery file.
PREAMBLE = ["Parameters:Attribution Model = linear", "Parameters:TimeZone=America/Detroit"]
HEADER = ["Google Click ID", "Conversion Name", "Conversion Time", "Attributed Credit",
          "Conversion Value", "Conversion Currency"]
ROWS_PER_FILE = 1_000_000


def csv_field(c: Column) -> Column:
    """Minimal CSV quoting of one text field; NULL -> empty."""
    special = c.contains(",") | c.contains('"') | c.contains("\r") | c.contains("\n")
    return (F.when(c.isNull(), F.lit(""))
            .when(special, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
            .otherwise(c))


def number_text(c: Column) -> Column:
    """Shortest plain text of a double; no exponent, at least one digit after the point."""
    s = c.cast("double").cast("string")
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    whole = F.regexp_extract(s, "^-?([0-9])[.]", 1)
    part = F.regexp_replace(F.regexp_extract(s, "[.]([0-9]+)E", 1), "0+$", "")
    power = F.regexp_extract(s, "E(-?[0-9]+)$", 1).cast("int")
    digits = F.rpad(part, F.greatest(power, F.length(part)), F.lit("0"))
    large = F.concat(whole, F.substring(digits, F.lit(1), power), F.lit("."),
                     F.rpad(F.substring(digits, power + 1, F.length(digits)), F.greatest(F.length(digits) - power, F.lit(1)), F.lit("0")))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), whole, part)
    return F.when(~s.rlike("[0-9]E-?[0-9]"), s).otherwise(F.concat(sign, F.when(power < 0, small).otherwise(large)))


def _text_line(fields: list[Column]) -> Column:
    return F.concat_ws(",", *[csv_field(f) for f in fields])


def delivery_lines(undelivered: DataFrame) -> DataFrame:
    """Lines of the delivery file as ``(section, seq, line)``; section 0 = preamble + header."""
    spark = undelivered.sparkSession
    head = [(0, i, _plain_line([p])) for i, p in enumerate(PREAMBLE)]
    head.append((0, len(PREAMBLE), _plain_line(HEADER)))
    head_df = spark.createDataFrame(head, "section int, seq long, line string")
    u = undelivered
    line = _text_line([u.gcl_id, u.conversion_name, u.conversion_time,
                       number_text(u.attributed_credit), number_text(u.conversion_value),
                       u.conversion_currency])
    rows = u.select(F.lit(1).alias("section"), F.lit(None).cast("long").alias("seq"), line.alias("line"))
    return head_df.unionByName(rows)


def _plain_line(fields: list[str]) -> str:
    out = []
    for f in fields:
        if any(ch in f for ch in ',"\r\n'):
            f = '"' + f.replace('"', '""') + '"'
        out.append(f)
    return ",".join(out)


MANIFEST = "_manifest.json"


def _totals(lines: DataFrame) -> tuple[int, int, int]:
    """Rows, physical lines (a quoted field may hold line ends) and the sum of their CRC-32s (in any order)."""
    pieces = F.split("line", "\r\n", -1)
    sums = F.aggregate(pieces, F.lit(0).cast("long"), lambda acc, x: acc + F.crc32(x.cast("binary")))
    return tuple(lines.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(pieces)), F.lit(0)), F.coalesce(F.sum(sums), F.lit(0))).first())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The physical lines (column ``line``) of a delivery's part files."""
    return spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").alias("line"))


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or ".", name


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo what a killed ``write_delivery`` left: the delivery before it stays unless the new one is whole."""
    parent, name = _split(path)
    folder = Folder(spark, parent)
    for old in [n for n in folder.names() if n.startswith(f"{name}.previous-")]:
        if folder.exists(name):
            folder.delete(old)
        else:
            folder.move(old, name)
    for draft in [n for n in folder.names() if n.startswith(f"{name}.staging-")]:
        folder.delete(draft)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """Parts, rows, lines and checksum of the delivery at ``path``."""
    return json.loads(Folder(spark, path).read(MANIFEST))


def write_delivery(undelivered: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """S4 + S5: write the delivery file under ``path``; skip (keep the old one) when empty.

    The parts go to a sibling folder, are read back and compared with the lines
    by number and checksum, and get a manifest; only then two renames put the
    folder in place of the one before.  One writer a path; ``recover``, called
    first, settles what a killed one left.  Returns the number of data rows
    written (0 = skipped).
    """
    spark = undelivered.sparkSession
    recover(spark, path)
    lines = delivery_lines(undelivered)
    n, physical, checksum = _totals(lines)
    rows = n - len(PREAMBLE) - 1
    if rows == 0:
        return 0
    parts = max(1, math.ceil(rows / rows_per_file))
    parent, name = _split(path)
    folder, run = Folder(spark, parent), uuid.uuid4().hex
    staged = f"{parent}/{name}.staging-{run}"
    (lines.repartitionByRange(parts, "section", "seq", "line")
     .sortWithinPartitions("section", "seq", "line")
     .select("line")
     .write.option("lineSep", "\r\n").text(staged))
    written = Folder(spark, staged)
    if _totals(read_lines(spark, staged))[1:] != (physical, checksum):
        raise RuntimeError(f"{staged} does not hold the lines of this delivery")
    written.write(MANIFEST, json.dumps({"parts": sorted(x for x in written.names() if x.startswith("part-")), "rows": rows, "lines": physical, "checksum": checksum}))
    if folder.exists(name):
        folder.move(name, f"{name}.previous-{run}")
    if not folder.move(f"{name}.staging-{run}", name):
        raise RuntimeError(f"{path} was written by someone else")
    folder.delete(f"{name}.previous-{run}")
    return rows
