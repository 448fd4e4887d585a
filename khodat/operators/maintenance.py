"""Snapshot expiry and orphan files, as queries over metadata tables."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khodat.schema import SNAPSHOTS_KEPT


def expired_snapshots(
    log: DataFrame,
    older_than: Column | None = None,
    retain_last: int = SNAPSHOTS_KEPT,
    table: str = "table",
    snapshot: str = "snapshot_id",
    committed: str = "committed_at",
) -> DataFrame:
    """Snapshots committed before ``older_than``, except the newest ``retain_last`` of their table.

    By default the bound is the coming midnight, so that only ``retain_last`` protects a snapshot.

    The newest few of each table are picked on the map side before any shuffle; the rest is compared with the
    oldest one kept. So no task ever holds all snapshots of a table.
    """
    if retain_last < 1:
        raise ValueError("at least one snapshot of a table is kept")
    if older_than is None:
        older_than = F.date_add(F.current_date(), 1)
    newest_first = Window.partitionBy(table).orderBy(F.desc(committed), F.desc(snapshot))
    oldest_kept = (
        log.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == retain_last)
        .select(table, F.col(committed).alias("_kept_at"), F.col(snapshot).alias("_kept_id"))
    )
    older = (F.col(committed) < F.col("_kept_at")) | (
        (F.col(committed) == F.col("_kept_at")) & (F.col(snapshot) < F.col("_kept_id"))
    )
    return (
        log.where(F.col(committed) < older_than)
        .join(oldest_kept, table)
        .where(older)
        .select(*log.columns)
    )


def plain_path(path: Column) -> Column:
    """A file's path in one form: without scheme and authority, and with the escapes of a URI resolved. What has no scheme
    is no URI and stays as it is."""
    uri = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    text = path.cast("string")
    decoded = F.try_url_decode(F.regexp_replace(F.regexp_replace(text, uri, ""), r"\+", "%2B"))
    return F.when(F.regexp_like(text, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:/")), F.coalesce(decoded, F.regexp_replace(text, uri, ""))).otherwise(text)


def _folder(least: str, most: str) -> str:
    """The deepest folder that all paths from the least to the greatest are below."""
    return os.path.commonprefix([least, most]).rpartition("/")[0] or "/"


def orphan_files(
    listing: DataFrame, manifest: DataFrame, older_than: Column | None = None, path: str = "path", mtime: str = "mtime",
    roots: Sequence[str] = (),
) -> DataFrame:
    """Listed files no manifest entry refers to, last modified before ``older_than`` (midnight two days ago).

    Both sides name files as ``list_files`` and ``_metadata.file_path`` do. Scheme and authority may differ: paths are
    compared without them. ``roots`` are the folders that were listed, by default one that holds all. Where no file of a root is
    referenced, though the manifest refers to some, it speaks of another place, and every live file would be reported:
    that raises. Both sides are brought together by path once, where each path's rows are counted by side.
    """
    if older_than is None:
        older_than = F.date_sub(F.current_date(), 2)
    rows = listing.select(plain_path(F.col(path)).alias("_path"), F.struct(*listing.columns).alias("_row"))
    entries = manifest.select(plain_path(F.col(path)).alias("_path")).where("_path is not null")
    tagged = rows.unionByName(entries, allowMissingColumns=True)
    listed, referenced = F.count("_row"), F.count(F.when(F.col("_row").isNull(), 1))
    paths = tagged.groupBy("_path").agg(listed.alias("_listed"), referenced.alias("_referenced"))
    plain = [r.plain for r in listing.sparkSession.createDataFrame([(r,) for r in roots], "root string").select(plain_path(F.col("root")).alias("plain")).collect()] if roots else []
    root = F.coalesce(*[F.when(F.startswith("_path", F.lit(r.rstrip("/") + "/")), F.lit(r)) for r in plain], F.lit("")) if plain else F.lit("")
    ours, theirs = F.when(F.col("_listed") > 0, F.col("_path")), F.when(F.col("_referenced") > 0, F.col("_path"))
    seen = paths.groupBy(root.alias("root")).agg(
        F.max(F.least("_listed", "_referenced")).alias("matched"), F.min(ours).alias("first"), F.max(ours).alias("last"), F.min(theirs).alias("least"), F.max(theirs).alias("most"),
    ).collect()  # one row for each root
    least, most = (pick((r[c] for r in seen if r[c] is not None), default=None) for c, pick in (("least", min), ("most", max)))
    for r in seen:
        if r["first"] is not None and least is not None and not r["matched"]:
            raise ValueError(f"listed files are below {_folder(r['first'], r['last'])}, referenced ones below {_folder(least, most)}")
    old = listing.withColumn("_path", plain_path(F.col(path))).where(F.col(mtime) < older_than)
    return old.join(entries.distinct(), "_path", "left_anti").select(*listing.columns)
