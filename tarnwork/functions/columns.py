"""Column-level operators: projections, technical columns, hashes, masking, cleaning."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TECHNICAL_PREFIX = "dl_"
NULL_MARK = "~"  # stands for null inside a row hash, so that null and '' differ
NBSP = "\u00a0"


def lit_like(df: DataFrame, expr: str, value) -> Column:
    """A literal in the type of a column expression. Comparing a column with a literal of another time type would cast
    the column and keep the filter from being pushed into the scan."""
    return F.lit(value).cast(df.select(F.expr(expr)).schema[0].dataType)


def project(df: DataFrame, exprs: list[str] | None) -> DataFrame:
    """SQL-expression projection; an empty list keeps every column."""
    return df.selectExpr(*exprs) if exprs else df


def validate_keys(df: DataFrame, keys: list[str], required: bool = True) -> list[str]:
    """The keys in lower case; an error when a needed key list is empty or a key is no column."""
    wanted = [k.strip().lower() for k in keys or []]
    if required and not wanted:
        raise ValueError("key columns are required")
    missing = sorted(set(wanted) - {c.lower() for c in df.columns})
    if missing:
        raise ValueError(f"key columns not in the data: {', '.join(missing)}")
    return wanted


def norm(col: str | Column) -> Column:
    """Case- and space-insensitive key: ``upper(trim(col))``."""
    return F.upper(F.trim(F.col(col) if isinstance(col, str) else col))


def with_norm_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``<col>_norm`` once, before any join uses it."""
    return df.withColumns({f"{c}_norm": norm(c) for c in cols})


def row_hash(df: DataFrame, cols: list[str] | None = None, prefix: str = "") -> Column:
    """SHA-256 over the '|'-joined values of the sorted columns; by default all but the technical ones.

    Every value is preceded by its length, so no other row has the same text and a value like the null mark is not null.
    With ``prefix`` the values are read from columns whose names begin with it.
    """
    chosen = sorted(cols if cols is not None else [c for c in df.columns if not c.startswith(TECHNICAL_PREFIX)])
    texts = [F.col(prefix + c).cast("string") for c in chosen]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts]
    return F.sha2(F.concat_ws("|", *marked), 256)


def technical_values(batch_time: datetime, elt_id: str, run_id: str, file_path: Column | None = None, file_name: Column | None = None) -> dict[str, Column]:
    """The technical columns that are the same for all rows of a batch (or tell of a row's file)."""
    batch = F.lit(batch_time)
    none = F.lit("")
    return {
        "dl_partitionkey": F.date_format(batch, "yyyyMMdd"),
        "dl_iscurrent": F.lit(1),
        "dl_recordstartdateutc": batch,
        "dl_recordenddateutc": F.lit(None).cast(T.TimestampNTZType() if batch_time.tzinfo is None else T.TimestampType()),
        "dl_createddateutc": batch,
        "dl_lastmodifiedutc": batch,
        "dl_sourcefilepath": file_path if file_path is not None else none,
        "dl_sourcefilename": file_name if file_name is not None else none,
        "dl_eltid": F.lit(elt_id),
        "dl_runid": F.lit(run_id),
        "dl_is_deleted": F.lit(0),
    }


def add_technical_columns(
    df: DataFrame, batch_time: datetime, elt_id: str, run_id: str, file_path: Column | None = None, file_name: Column | None = None
) -> DataFrame:
    """Stamp the technical columns of a curated row. ``file_path``/``file_name`` default to empty text; pass
    ``F.col("_metadata.file_path")`` for file sources."""
    return df.withColumns({"dl_rowhash": row_hash(df), **technical_values(batch_time, elt_id, run_id, file_path, file_name)})


def with_year_month(df: DataFrame, ts: str, prefix: str | None = None) -> DataFrame:
    """Partition columns ``<prefix>_year`` and ``<prefix>_month``."""
    p = prefix or ts
    return df.withColumns({f"{p}_year": F.year(ts), f"{p}_month": F.month(ts)})


def classify(rules: list[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """The value of the first rule that holds, else ``default``."""
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    chain = F
    for cond, value in rules:
        chain = chain.when(cond, lit(value))
    return chain.otherwise(lit(default))


def default_keys(df: DataFrame, cols: list[str], default: int = -1) -> DataFrame:
    """Unknown-member default for looked-up keys."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in cols})


def prefer(present: Column, first: Column, second: Column) -> Column:
    """The first source's value whenever its row is present, even if that value is null."""
    return F.when(present.isNotNull(), first).otherwise(second)


def replace_when(df: DataFrame, cond: Column, values: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per output column one of two values: ``{column: (when cond holds, otherwise)}``."""
    return df.withColumns({c: F.when(cond, a).otherwise(b) for c, (a, b) in values.items()})


def mask_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null out sensitive columns, keeping their types."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in cols})


def encrypt_columns(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """AES-GCM, base64 text. ``key`` has 16, 24 or 32 bytes."""
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string"), F.lit(key), F.lit("GCM"))) for c in cols})


def decrypt_columns(df: DataFrame, cols: list[str], key: str, types: dict[str, str] | None = None) -> DataFrame:
    types = types or {}
    return df.withColumns({
        c: F.aes_decrypt(F.unbase64(F.col(c)), F.lit(key), F.lit("GCM")).cast("string").cast(types.get(c, "string")) for c in cols
    })


def safe_projection(df: DataFrame, table: str, pii: DataFrame) -> DataFrame:
    """Drop the columns that the PII list ``(dataset_name, column_name, include_in_load)`` excludes from loading.

    The list holds column names of one table, no more than the table has columns."""
    rows = pii.filter((F.lower("dataset_name") == table.lower()) & (F.col("include_in_load") == 0))
    names = rows.select(F.lower("column_name").alias("c")).distinct()
    hidden = {r["c"] for r in names.filter(F.col("c").isin([c.lower() for c in df.columns])).collect()}
    return df.select(*[c for c in df.columns if c.lower() not in hidden])


def row_policy(df: DataFrame, role: str, policies: dict[str, str]) -> DataFrame:
    """Rows that the role's predicate allows; an unknown role sees none."""
    return df.filter(F.expr(policies[role])) if role in policies else df.filter(F.lit(False))


def entitled_rows(df: DataFrame, entitlements: DataFrame, role: str, keys: list[str]) -> DataFrame:
    """Rows whose key the entitlement table ``(role, keys…)`` grants to the role."""
    return df.join(entitlements.filter(F.col("role") == role).select(*keys), keys, "left_semi")


def clean_strings(df: DataFrame) -> DataFrame:
    """Remove non-breaking spaces from every string column and trim white space at both ends."""
    blank = " \t\n\r\x0b\x0c"
    return df.withColumns({
        c: F.btrim(F.translate(F.col(c), NBSP, ""), F.lit(blank)) for c, t in df.dtypes if t == "string"
    })


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null or blank."""
    kept = None
    for c, t in df.dtypes:
        filled = F.col(c).isNotNull() & (F.trim(F.col(c)) != "") if t == "string" else F.col(c).isNotNull()
        kept = filled if kept is None else kept | filled
    return df.filter(kept)


def lower_all(df: DataFrame) -> DataFrame:
    """Lower-case every string column."""
    return df.withColumns({c: F.lower(c) for c, t in df.dtypes if t == "string"})


def business_key(prefix: str, *parts: Column | str, sep: str = "-") -> Column:
    """``prefix`` and the parts joined by ``sep``; null if a part is null."""
    pieces = [F.lit(prefix)]
    for p in parts:
        pieces += [F.lit(sep), p if isinstance(p, Column) else F.col(p).cast("string")]
    return F.concat(*pieces)


def parse_timestamp(col: str | Column, formats: list[str]) -> Column:
    """The first format that fits; null if none does."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def units(col: str | Column, scale: int = 2) -> Column:
    """A double amount as a whole number of its smallest unit, in decimal form so that sums cannot overflow; what lies
    beyond ``scale`` places is rounded away, value by value (three times 0.004 makes 0 at two places). ``total_of``
    refuses such values instead. Casting a double to a decimal with places goes through text and is many times slower."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c * F.lit(10.0**scale)).cast("long").cast("decimal(18,0)")


def exact_sum(col: str | Column, scale: int = 2) -> Column:
    """Order-independent sum of a double amount of ``scale`` places, as decimal; see ``units`` for more places."""
    return F.sum(units(col, scale)) * F.lit(Decimal(1).scaleb(-scale))


def money_sum(col: str | Column, scale: int = 2) -> Column:
    """Order-independent sum of a double amount of ``scale`` places, returned as double; see ``units`` for more places."""
    return exact_sum(col, scale).cast("double")


def total_of(df: DataFrame, col: str, scale: int = 2, times: Column | None = None) -> Column:
    """Exact sum of a column of any number type. Decimals keep their own scale; doubles are amounts of ``scale`` places,
    and one that has more fails the query instead of being rounded. ``times`` tells how often a row counts."""
    kind = df.schema[col].dataType

    def counted(value: Column) -> Column:
        return value if times is None else value * times.cast("decimal(19,0)")

    if isinstance(kind, (T.DoubleType, T.FloatType)):
        raw = F.col(col) * F.lit(10.0**scale)
        off = F.abs(raw - F.rint(raw)) > F.greatest(F.lit(1e-4), F.abs(raw) * F.lit(1e-12))
        fail = F.raise_error(F.concat(F.lit(f"{col} has more than {scale} places: "), F.col(col).cast("string"))).cast("double")
        return F.sum(counted(units(F.when(off, fail).otherwise(F.col(col)), scale))) * F.lit(Decimal(1).scaleb(-scale))
    return F.sum(counted(F.col(col) if isinstance(kind, T.DecimalType) else F.col(col).cast("decimal(19,0)")))
