"""Delimited files for the receiving system.

A fact is one file, as the receiver expects, or as many numbered files as the caller
asks for, written in parallel. The names follow from that number and not from the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import contracts
from kpiloom.operators.relational import earliest_date
from kpiloom.session import file_system, land_observed, remove_folder, work_folder

# No quoting, CRLF, '' for NULL and for the empty text.
_DIALECT = {
    "lineSep": "\r\n",
    "encoding": "UTF-8",
    "quote": "",
    "escape": "",
    "emptyValue": "",
    "nullValue": "",
    "header": "true",
}


def separator_safe(c: Column, sep: str, on_clash: str = "replace") -> Column:
    """Text without the separator and line ends, which an unquoted file cannot hold."""
    forbidden = sep + "\r\n"
    if on_clash == "replace":
        return F.translate(c, forbidden, " " * len(forbidden))
    if on_clash == "error":
        clash = c != F.translate(c, forbidden, "")
        return F.when(clash, F.raise_error(F.concat(F.lit("separator in field: "), c))).otherwise(c)
    raise ValueError(f"unknown clash policy: {on_clash}")


def _safe(df: DataFrame, sep: str, on_clash: str) -> DataFrame:
    return df.select(
        *[
            separator_safe(F.col(f.name), sep, on_clash).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def export_csv(df: DataFrame, path: str, sep: str = ",", on_clash: str = "replace", files: int = 1) -> None:
    """Writes the frame below `path` in so many files, or fewer if there are fewer rows."""
    _safe(df, sep, on_clash).repartition(files).write.mode("overwrite").options(sep=sep, **_DIALECT).csv(path)


def export_one_file(df: DataFrame, path: str, sep: str = ",", on_clash: str = "replace") -> None:
    """Writes the frame as the only file below `path`, printed by many tasks.

    Rows are neither shuffled nor read by one task: every task writes a part without a
    header, and the parts are then strung together as bytes, through one buffer.
    """
    spark, parts = df.sparkSession, f"{path}/parts"
    _safe(df, sep, on_clash).write.mode("overwrite").options(**(_DIALECT | {"sep": sep, "header": "false"})).csv(parts)
    fs, to_path = file_system(spark, path)
    io = spark._jvm.org.apache.hadoop.io.IOUtils
    target = fs.create(to_path(f"{path}/part-00000"), True)
    try:
        target.write(bytearray((sep.join(df.columns) + _DIALECT["lineSep"]).encode()))
        for part in sorted(str(s.getPath()) for s in fs.globStatus(to_path(f"{parts}/part-*"))):
            source = fs.open(to_path(part))
            try:
                io.copyBytes(source, target, 1 << 20, False)
            finally:
                source.close()
    finally:
        target.close()


def publish_files(
    spark: SparkSession, staged: str, folder: str, base: str, suffix: str = ".csv", numbered: bool = False
) -> list[str]:
    """Moves the staged part file to `<folder>/<base>.csv`, or `numbered` ones to `<base>-00001.csv` and so on.

    Files of an earlier run under the same name are replaced.
    """
    fs, path = file_system(spark, folder)
    parts = sorted(str(s.getPath()) for s in fs.globStatus(path(f"{staged}/part-*")))
    if len(parts) > 1 and not numbered:
        raise ValueError(f"{len(parts)} files for one name: {base}{suffix}")
    numbers = [f"-{i:05d}" for i in range(1, len(parts) + 1)] if numbered else [""]
    fs.mkdirs(path(folder))
    for pattern in (f"{base}{suffix}", f"{base}-[0-9][0-9][0-9][0-9][0-9]{suffix}"):
        for earlier in fs.globStatus(path(f"{folder}/{pattern}")) or []:
            fs.delete(earlier.getPath(), False)
    targets = [f"{folder}/{base}{number}{suffix}" for number in numbers]
    for part, target in zip(parts, targets, strict=True):
        if not fs.rename(path(part), path(target)):
            raise OSError(f"cannot move {part} to {target}")
    remove_folder(spark, staged)
    return targets


def _write(df: DataFrame, root: str, fact: str, base: str, files: int = 1, **options) -> list[str]:
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{fact}s"
    staged = f"{root.rstrip('/')}/_staging/{fact}s/{base}"
    if files == 1:
        export_one_file(df, staged, contracts.FILE_SEPARATOR[fact], **options)
    else:
        export_csv(df, staged, contracts.FILE_SEPARATOR[fact], files=files, **options)
    return publish_files(spark, staged, folder, base, numbered=files > 1)


def publish(
    df: DataFrame,
    root: str,
    fact: str,
    region: str,
    prefix: str,
    on_date: date | None = None,
    fallback: date | None = None,
    **options,
) -> list[str]:
    """Business-dated export `<prefix>_<region>_<Fact>-<yyyyMMdd>.csv`.

    The date is `on_date`, else the earliest order date (status date of
    cancellations) of the fact, else `fallback`. A fact without rows and dates is no file.
    """
    with _counted(df, fact) as (rows, seen):
        day = on_date or seen["day"] or fallback
        if day is None and not seen["rows"]:
            return []
        if day is None:
            raise ValueError(f"no business date for {fact}")
        base = f"{prefix}_{region}_{contracts.FILE_WORD[fact]}-{day:%Y%m%d}"
        return _write(rows, root, fact, base, **options)


def publish_facts(
    facts: dict[str, DataFrame],
    root: str,
    region: str,
    prefix: str,
    on_date: date | None = None,
    one_date: bool = False,
    **options,
) -> dict[str, list[str]]:
    """Business-dated exports of several facts; one without rows is no file.

    With `one_date` all are named by the earliest order date of all of them, cancellations
    included; else each by its own date, as in `publish`. Each fact is computed once.
    """
    with ExitStack() as stack:
        seen = {
            fact: stack.enter_context(_counted(df, fact, "Order_Date" if one_date else None)) for fact, df in facts.items()
        }
        days = [s["day"] for _, s in seen.values() if s["day"]]
        common = on_date or (min(days, default=None) if one_date else None)
        written = {}
        for fact, (rows, counted) in seen.items():
            day = common or counted["day"]
            if not counted["rows"]:
                written[fact] = []
                continue
            if day is None:
                raise ValueError(f"no business date for {fact}")
            base = f"{prefix}_{region}_{contracts.FILE_WORD[fact]}-{day:%Y%m%d}"
            written[fact] = _write(rows, root, fact, base, **options)
        return written


def publish_window(
    df: DataFrame, root: str, fact: str, region: str, prefix: str, start: date, end: date, **options
) -> list[str]:
    """Export of a history slice `<prefix>_<region>_<Fact>_<start>_<end>.csv`; without rows there is no file."""
    base = f"{prefix}_{region}_{contracts.FILE_WORD[fact]}_{start:%Y%m%d}_{end:%Y%m%d}"
    with _counted(df, fact) as (rows, seen):
        return _write(rows, root, fact, base, **options) if seen["rows"] else []


@contextmanager
def _counted(df: DataFrame, fact: str, date_column: str | None = None) -> Iterator[tuple[DataFrame, dict]]:
    """The landed fact with its number of rows and earliest date, taken in the pass that lands it."""
    folder = work_folder(df.sparkSession, f"export-{fact}")
    day = earliest_date(date_column or contracts.BUSINESS_DATE_COLUMN[fact])
    try:
        yield land_observed(df, folder, rows=F.count(F.lit(1)), day=day)
    finally:
        remove_folder(df.sparkSession, folder)
