"""Delimited files as they come: the delimiter, encoding and header of each are found, and all are united by column name.

A file is told from its first SAMPLE bytes, which the driver reads; its rows are read by Spark. Files with one delimiter, encoding and header are
read together, so the plan grows with the number of different forms, not with that of the files.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE = 4096
DELIMITERS = (",", ";", "\t", "|")
MARKS = ((b"\xef\xbb\xbf", "UTF-8"), (b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE"))
READERS = 16


def listed(spark: SparkSession, path: str) -> list[str]:
    """Files under a path or pattern, those in its folders too; hidden ones and markers are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs, found = root.getFileSystem(conf), []
    todo = [s for s in fs.globStatus(root) or []]
    while todo:
        status = todo.pop()
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if status.isDirectory():
            todo += list(fs.listStatus(status.getPath()))
        elif status.getLen():
            found.append(status.getPath().toString())
    return sorted(found)


def head(spark: SparkSession, path: str) -> bytes:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, SAMPLE)))
    finally:
        stream.close()


def encoding_of(sample: bytes) -> str:
    """By the mark at the start; else UTF-8, unless more bytes are no UTF-8 than there are characters beyond ASCII in it."""
    for mark, name in MARKS:
        if sample.startswith(mark):
            return name
    text = sample.decode("utf-8", "replace")
    if len(sample) >= SAMPLE:
        text = text[:-1]  # may be cut within a character
    broken = text.count("�")
    return "UTF-8" if broken <= sum(c > "\x7f" for c in text) - broken else "ISO-8859-1"


def delimiter_of(lines: list[str]) -> str:
    """The one that stands in all sampled lines most evenly: by the lines with as many as the header, then by their number."""
    def rank(d: str):
        counts = [len(next(csv.reader([line], delimiter=d), [])) for line in lines]
        return (counts[0] > 1, sum(n == counts[0] for n in counts) if counts[0] > 1 else 0, counts[0], -DELIMITERS.index(d))

    return max(DELIMITERS, key=rank)


def form_of(sample: bytes) -> tuple[str, str, tuple[str, ...]]:
    """Delimiter, encoding and header of a file's first bytes; a last line that may be cut is not looked at."""
    encoding = encoding_of(sample)
    lines = sample.decode(encoding, "replace").lstrip("﻿").splitlines()
    lines = [x for x in (lines[:-1] if len(sample) >= SAMPLE and len(lines) > 1 else lines) if x.strip()]
    if not lines:
        return ",", encoding, ()
    delimiter = delimiter_of(lines)
    return delimiter, encoding, tuple(c.strip().lower() for c in next(csv.reader([lines[0]], delimiter=delimiter)))


def forms(spark: SparkSession, path: str) -> dict[tuple, list[str]]:
    """Files by delimiter, encoding and header."""
    files = listed(spark, path)
    with ThreadPoolExecutor(READERS) as pool:
        found = list(pool.map(lambda f: form_of(head(spark, f)), files))
    out = defaultdict(list)
    for form, file in zip(found, files):
        out[form].append(file)
    return dict(out)


def read_listing_files(spark: SparkSession, path: str, ragged: str = "keep") -> DataFrame:
    """All columns of all files as strings, source_file, and bad_line: the text of a line with too few or too many fields.

    Columns are known by name, whatever their order and case; a file without a column has nulls there, as has a ragged line where it
    ends early. ragged "keep" returns such lines, "skip" leaves them out, "only" returns nothing else (the quarantine). Bytes
    that do not fit the encoding become U+FFFD. Names that repeat in a header get a number. Empty files and files of a header only have
    no rows; without any file the table has the two last columns alone.
    """
    parts = []
    for (delimiter, encoding, header), files in sorted(forms(spark, path).items()):
        if not header:
            continue
        names: list[str] = []
        for c in header:
            n, name = 1, c or "column"
            while name in names or name in ("bad_line", "source_file"):
                n += 1
                name = f"{c or 'column'}_{n}"
            names.append(name)
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, "bad_line"])
        # Without pruning a line is bad or not whatever columns a query asks for.
        read = spark.read.option("columnPruning", False).csv(files, schema=schema, header=True, sep=delimiter, encoding=encoding, mode="PERMISSIVE", escape='"', columnNameOfCorruptRecord="bad_line", enforceSchema=True)
        # Spark refuses to read the bad lines alone: the second part, always null, makes it read the first column too.
        first = F.col(f"`{names[0].replace('`', '``')}`")
        parts.append(read.withColumn("bad_line", F.coalesce("bad_line", F.nullif(first, first))).withColumn("source_file", F.input_file_name()))
    if not parts:
        return spark.createDataFrame([], "source_file string, bad_line string")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rows = rows if ragged == "keep" else rows.where("bad_line is null" if ragged == "skip" else "bad_line is not null")
    last = ["source_file", "bad_line"]
    return rows.select(*[F.col(f"`{c.replace('`', '``')}`") for c in rows.columns if c not in last], *last)


def json_records(text: Column) -> Column:
    """Records of a JSON text: the length of a list, 1 for any other value, null if it is none."""
    return F.coalesce(F.json_array_length(text), F.when(F.try_parse_json(text).isNotNull(), 1)).cast("long")
