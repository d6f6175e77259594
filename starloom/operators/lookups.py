"""Splitting rows by what the warehouse already holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import fits_broadcast, stage
from starloom.specs import DimRef, OpResult

MISSING_REFS = "missing_refs"
ORPHAN_REASON = "orphan_reason"
IS_DUPLICATE = "is_duplicate"


def _checked_refs(df: DataFrame, refs: Iterable[DimRef]) -> list[DimRef]:
    return [r for r in refs if isinstance(r.fk, str) and r.fk in df.columns]


def _comparable(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> tuple[Column, Column]:
    """Both keys as they are where the types agree, as text otherwise."""
    a, b = F.col(left_key), F.col(right_key)
    if left.schema[left_key].dataType == right.schema[right_key].dataType:
        return a, b
    return a.cast("string"), b.cast("string")


def tag_orphans(df: DataFrame, dims: Mapping[str, DataFrame], refs: Iterable[DimRef]) -> DataFrame:
    """Add the array of missing references and a reason text to every row.

    Null keys, list-valued keys and absent columns are not checked.
    """
    refs = _checked_refs(df, refs)
    out, hits = df, []
    for i, ref in enumerate(refs):
        fk, pk = _comparable(df, ref.fk, dims[ref.dim], ref.pk or ref.fk)
        known = dims[ref.dim].select(pk.alias(f"__pk{i}")).dropna().distinct()
        out = out.join(known, fk == F.col(f"__pk{i}"), "left")
        hits.append(F.col(ref.fk).isNotNull() & F.col(f"__pk{i}").isNull())
    return _with_missing(out, df.columns, refs, hits)


def missing_references(df: DataFrame, dims: Mapping[str, DataFrame], refs: Iterable[DimRef]) -> DataFrame:
    """(ref, value) of all references that no dimension row has; ``ref`` is the place in ``refs``, ``value`` is text.

    All references become one relation, reduced on the map side, and meet all
    dimensions in one join, so ``df`` is read once whatever their number.
    """
    refs = list(refs)
    pairs = F.array(*[F.struct(F.lit(i).alias("ref"), F.col(r.fk).cast("string").alias("value")) for i, r in enumerate(refs)])
    keys = df.select(F.inline(pairs)).dropna().distinct()
    known = [dims[r.dim].select(F.lit(i).alias("ref"), F.col(r.pk or r.fk).cast("string").alias("value")) for i, r in enumerate(refs)]
    return keys.join(reduce(DataFrame.union, known), ["ref", "value"], "left_anti")


def tag_orphans_by_missing_keys(
    df: DataFrame,
    dims: Mapping[str, DataFrame],
    refs: Iterable[DimRef],
    keys_of: DataFrame | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Same result as ``tag_orphans`` for large dimensions; reads ``df`` twice whatever their number.

    The distinct keys of ``df`` (reduced on the map side, so a hot key costs
    one row per task) are checked against the dimensions.  Only the missing
    keys are joined back.  They are staged first, so Spark knows their size:
    few keys are broadcast and the wide rows are not shuffled at all, many
    keys take an ordinary shuffle join.  ``keys_of`` names a cheaper frame
    with the same keys, where ``df`` is an unstaged plan over it.  The missing
    keys are computed by this call, into ``scratch``.
    """
    refs = _checked_refs(df, refs)
    if not refs:
        return _with_missing(df, df.columns, refs, [])
    gone = stage(missing_references(df if keys_of is None else keys_of, dims, refs), "missing-keys", scratch)
    out, hits = df, []
    for i, ref in enumerate(refs):
        lost = gone.filter(F.col("ref") == i).select(F.col("value").alias(f"__gone{i}"))
        out = out.join(lost, F.col(ref.fk).cast("string") == F.col(f"__gone{i}"), "left")
        hits.append(F.col(f"__gone{i}").isNotNull())
    return _with_missing(out, df.columns, refs, hits)


def _with_missing(joined: DataFrame, columns: list[str], refs: list[DimRef], hits: list[Column]) -> DataFrame:
    entries = [
        F.when(
            hit,
            F.struct(
                F.lit(ref.dim).alias("dim"),
                F.lit(ref.fk).alias("fk_column"),
                F.col(ref.fk).cast("string").alias("fk_value"),
            ),
        )
        for ref, hit in zip(refs, hits)
    ]
    reasons = [F.when(hit, F.lit(f"{ref.fk} is not in {ref.dim}; ")) for ref, hit in zip(refs, hits)]
    if not refs:
        empty = F.array().cast("array<struct<dim:string,fk_column:string,fk_value:string>>")
        return joined.select(*columns, empty.alias(MISSING_REFS), F.lit("").alias(ORPHAN_REASON))
    return joined.select(
        *columns,
        F.array_compact(F.array(*entries)).alias(MISSING_REFS),
        F.concat_ws("", *reasons).alias(ORPHAN_REASON),
    )


def split_tagged_orphans(tagged: DataFrame) -> OpResult:
    return OpResult(
        tagged.filter(F.size(MISSING_REFS) == 0).drop(MISSING_REFS, ORPHAN_REASON),
        tagged.filter(F.size(MISSING_REFS) > 0),
    )


def split_orphans(df: DataFrame, dims: Mapping[str, DataFrame], refs: Iterable[DimRef]) -> OpResult:
    """Rows whose references all exist, and rows with at least one missing.

    Dimensions that are surely below the broadcast threshold are joined as they are; if one may be larger, only the
    missing keys meet the rows.
    """
    refs = _checked_refs(df, refs)
    small = all(fits_broadcast(dims[r.dim].select(r.pk or r.fk)) for r in refs)
    return split_tagged_orphans((tag_orphans if small else tag_orphans_by_missing_keys)(df, dims, refs))


def comparable_columns(df: DataFrame, ignore: Iterable[str]) -> list[str]:
    ignore = set(ignore)
    return [c for c in df.columns if c not in ignore]


def stored_candidates(
    df: DataFrame, stored: DataFrame, key: str, folders: Iterable[str] = (), scratch: str | None = None
) -> DataFrame:
    """The stored rows whose key occurs in ``df``, for tables too large to scan whole.

    First only the key column is scanned.  With no hit, as for a batch of new
    rows, that is all.  Otherwise the wide scan is limited to the hit keys and
    to the ``folders`` (partition columns of the stored table) they lie in.
    The hits are computed by this call, into ``scratch``.
    """
    folders = list(folders)
    keys = df.select(F.col(key).alias("__key")).dropna().distinct()
    hits = stage(
        stored.select(key, *folders).join(keys, F.col(key) == F.col("__key"), "left_semi").distinct(), "stored-keys", scratch
    )
    if hits.isEmpty():
        return stored.filter(F.lit(False))
    for c in folders:
        # one value per folder of the table, not per row
        values = [r[0] for r in hits.select(c).distinct().collect()]
        known = F.col(c).isin(*[v for v in values if v is not None])
        stored = stored.filter(known | F.col(c).isNull() if None in values else known)
    wanted = hits.select(F.col(key).alias("__hit")).distinct()
    return stored.join(wanted, F.col(key) == F.col("__hit"), "left_semi")


def tag_duplicates(df: DataFrame, stored: DataFrame, key: str, ignore: Iterable[str] = ()) -> DataFrame:
    """Flag rows that equal a stored row in every compared column, null equal to null.

    ``ignore`` names personal and date columns, which are not compared but
    stay in the row.  Each side is shuffled once; a stored table that is much
    larger than the batch is cut down by ``stored_candidates`` before.
    """
    compared = [c for c in comparable_columns(df, ignore) if c in stored.columns]
    if key not in compared:
        compared.insert(0, key)
    types = {f.name: f.dataType for f in df.schema.fields}
    old = stored.select(*[F.col(c).cast(types[c]).alias(f"__old_{c}") for c in compared])
    old = old.filter(F.col(f"__old_{key}").isNotNull()).distinct()
    same = F.col(key) == F.col(f"__old_{key}")
    for c in compared:
        if c != key:
            same = same & F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    return df.join(old, same, "left").select(*df.columns, F.col(f"__old_{key}").isNotNull().alias(IS_DUPLICATE))


def split_duplicates(df: DataFrame, stored: DataFrame, key: str, ignore: Iterable[str] = ()) -> OpResult:
    """New rows, and rows the stored table already holds."""
    tagged = tag_duplicates(df, stored, key, ignore)
    return OpResult(
        tagged.filter(~F.col(IS_DUPLICATE)).drop(IS_DUPLICATE),
        tagged.filter(F.col(IS_DUPLICATE)).drop(IS_DUPLICATE),
    )


def duplicate_reason(key: str, table: str) -> Column:
    return F.concat(
        F.lit(f"{table} already holds this row of {key} "), F.col(key).cast("string")
    )
