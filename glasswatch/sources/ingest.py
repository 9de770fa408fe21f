"""Checks and normalisation on the way from delivered sheets to bronze tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasswatch.functions.expressions import BLANKS
from glasswatch.schemas import OPTIONAL, PROVENANCE, RULES, bronze_type


def header_drift(headers: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Positions at which a delivered header differs from the expected one.

    ``headers`` has one row per delivery: ``source`` and the array ``header``. All positions of both are compared: a shorter
    header shows NULL for what it lacks, and a longer one shows NULL as what was wanted. No header at all lacks everything.
    """
    wanted = F.array(*[F.lit(name) for name in expected])
    got = F.coalesce("header", F.array().cast("array<string>"))
    pairs = F.arrays_zip(
        F.sequence(F.lit(0), F.greatest(F.size(got), F.lit(len(expected))) - 1).alias("position"),
        got.alias("got"),
        wanted.alias("want"),
    )
    return (
        headers.select("source", F.explode(pairs).alias("p"))
        .select("source", "p.position", "p.got", "p.want")
        .filter(~F.col("got").eqNullSafe(F.col("want")))
    )


def schema_differences(frames: dict[str, DataFrame]) -> list[str]:
    """Inputs of one table whose schema differs from the first one's. Looks at schemas only, runs nothing."""
    names = list(frames)
    first = [(f.name, f.dataType) for f in frames[names[0]].schema]
    return [n for n in names[1:] if [(f.name, f.dataType) for f in frames[n].schema] != first]


def require_same_schema(frames: dict[str, DataFrame]) -> None:
    different = schema_differences(frames)
    if different:
        raise ValueError(f"schema differs from the first input: {', '.join(different)}")


def normalise_cell(c: Column) -> Column:
    """NULL for an empty or not-applicable cell; any other text stays as it is, outer blanks included."""
    # fixed values: spellings of "nothing"
    return F.when(F.lower(F.btrim(c, F.lit(BLANKS))).isin("", "n/a", "na"), None).otherwise(c)


def normalise_time(c: Column) -> Column:
    """ISO text of a time; only the date if it is midnight."""
    day = F.date_format(c, "yyyy-MM-dd")
    # a fraction is written only when there is one
    fraction = F.when(F.date_format(c, "SSSSSS") != "000000", F.date_format(c, ".SSSSSS")).otherwise(F.lit(""))
    full = F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), fraction)
    return F.when(c == F.date_trunc("day", c).cast("timestamp_ntz"), day).otherwise(full)


def normalise_cells(df: DataFrame) -> DataFrame:
    """All text and time columns of a sheet normalised in one projection."""
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            c = normalise_cell(c)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = normalise_time(c.cast("timestamp_ntz"))
        out.append(c.alias(field.name))
    return df.select(*out)


def drop_empty_rows(df: DataFrame, sheet_columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every sheet cell is NULL."""
    cells = [c for c in df.columns if c not in PROVENANCE] if sheet_columns is None else list(sheet_columns)
    return df.dropna(how="all", subset=cells)


def stamp_provenance(
    df: DataFrame, product: Column, period: Column, sheet: Column, row_number: Column, sha256: Column
) -> DataFrame:
    """Add where a row came from. ``row_number`` counts data rows from 0; the header is row 1, so data starts at 2."""
    return df.withColumns(
        {
            "source_product": product,
            "source_period": period,
            "source_sheet": sheet,
            "source_row_index": (row_number + 2).cast("bigint"),
            "source_sha256": sha256,
        }
    )


def typed_by_prefix(df: DataFrame, sheet: str) -> DataFrame:
    """Column types from the column names; what does not parse becomes NULL."""
    return df.select(*[F.col(c).try_cast(bronze_type(sheet, c)).alias(c) for c in df.columns])


def violations(df: DataFrame, table: str) -> DataFrame:
    """Add ``violations``: the names of the columns that break a rule of the table, in rule order.

    Every row is checked. A column the table does not have is listed as an error before anything runs.
    """
    rules, optional = RULES[table], OPTIONAL.get(table, ())
    missing = [c for c in rules if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    broken = []
    for name, rule in rules.items():
        c = F.col(name)
        if rule is None:
            bad = c.isNull()
        else:
            bad = ~F.coalesce(rule(c), F.lit(name in optional))
        broken.append(F.when(bad, F.lit(name)))
    # concat_ws leaves out NULLs and, unlike a filter over an array, stays in generated code
    named = df.withColumn("_broken", F.concat_ws(",", *broken))
    listed = F.when(F.col("_broken") == "", F.array().cast("array<string>")).otherwise(F.split("_broken", ","))
    return named.withColumn("violations", listed).drop("_broken")


def forbid_extra(df: DataFrame, allowed: Sequence[str]) -> None:
    """Fail on columns outside the declared ones."""
    extra = [c for c in df.columns if c not in allowed]
    if extra:
        raise ValueError(f"unexpected columns: {', '.join(extra)}")


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows in quarantine with their violations)."""
    checked = violations(df, table)
    ok = F.size("violations") == 0
    return checked.filter(ok).drop("violations"), checked.filter(~ok)


def changed_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files (``path``, ``content`` as read by ``binaryFile``) whose SHA-256 differs from the manifest's.

    ``manifest`` has ``path`` and ``sha256`` of the last run; a file it does not know counts as changed.
    """
    hashed = files.select("path", F.sha2("content", 256).alias("sha256"))
    before = manifest.select("path", F.col("sha256").alias("previous_sha256"))
    return hashed.join(before, "path", "left").withColumn(
        "changed", ~F.col("sha256").eqNullSafe(F.col("previous_sha256"))
    )
