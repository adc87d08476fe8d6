"""Naming rules: field names, dataset names, surrogate keys, config paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(name: str) -> str:
    """OP-1 on a schema name: ``.`` and ``-`` become ``_``."""
    return name.replace(".", "_").replace("-", "_")


def normalise_name_col(c) -> Column:
    """OP-1 on names held as data (map keys, field lists)."""
    return F.translate(_col(c), ".-", "__")


def split_dataset_name(dataset_name: str) -> tuple[str, str]:
    """FN-3: ``db.table`` -> (db, table), split at the first dot."""
    if "." not in dataset_name:
        raise ValueError("dataset name must look like 'database.table'")
    db, table = dataset_name.split(".", 1)
    return db, table


def dataset_parts(c) -> tuple[Column, Column]:
    """FN-3 as columns: (db, table) of ``db.table``, split at the first dot."""
    parts = F.split(_col(c), r"\.", 2)
    return F.get(parts, F.lit(0)).alias("db"), F.get(parts, F.lit(1)).alias("table")


def with_scheme(url: str) -> str:
    """OP-3: default the scheme of a source address to ``http://``."""
    return url if url.startswith(("http://", "https://")) else f"http://{url}"


def with_scheme_col(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(r"^https?://"), c).otherwise(F.concat(F.lit("http://"), c))


def surrogate_key(*cols) -> Column:
    """FN-8: first 16 hex digits of SHA-256 over ``a|b``."""
    return F.substring(F.sha2(F.concat_ws("|", *[_col(c) for c in cols]), 256), 1, 16)


def key_hint(c) -> Column:
    """OP-13: first 8 characters of a key followed by ``...``."""
    return F.concat(F.substring(_col(c), 1, 8), F.lit("..."))


def template_name_from_path(path) -> Column:
    """FN-9: file stem; with ``_`` in it, the part after the last ``_``."""
    stem = F.regexp_extract(_col(path), r"([^/]+?)(\.[^./]*)?$", 1)
    return F.when(stem.contains("_"), F.element_at(F.split(stem, "_"), -1)).otherwise(stem)


def dataset_name_from_path(relative_path) -> Column:
    """FN-9: ``stem`` with ``_`` -> ``.``; inside a folder ``folder.`` is prefixed.

    ``relative_path`` is the file path relative to the config root.
    """
    p = _col(relative_path)
    stem = F.regexp_extract(p, r"([^/]+?)(\.[^./]*)?$", 1)
    dotted = F.regexp_replace(stem, "_", ".")
    folder = F.regexp_extract(p, r"^([^/]+)/", 1)
    return F.when(folder == F.lit(""), dotted).otherwise(F.concat(folder, F.lit("."), dotted))
