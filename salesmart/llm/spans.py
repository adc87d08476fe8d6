"""Matches of a regular expression with their places, by SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import WS

_CHUNK = 256
_NEAR = 60
OTHER = "\u2042"  # stands for a neighbouring match


def _other(place: str, match: str, behind: str) -> str:
    """SQL: the sign for a neighbouring match if ``place`` is not negative, else nothing."""
    mark = f", regexp_extract({match}, '[:=]$', 0)" if match else ""
    return f"CASE WHEN {place} >= 0 THEN concat('{OTHER}'{mark}, '{behind}') ELSE '' END"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _running(lengths: str) -> str:
    """Running sums of an array, in chunks so that long arrays stay near linear."""
    sums = f"transform(sequence(1, greatest(size({lengths}), 1), {_CHUNK}), c -> aggregate(slice({lengths}, c, {_CHUNK}), 0L, (a, x) -> a + x))"
    before = f"aggregate({sums}, array(0L), (a, x) -> array_append(a, element_at(a, -1) + x))"
    chunk = f"slice({lengths}, k * {_CHUNK} + 1, {_CHUNK})"
    within = f"slice(aggregate({chunk}, array(b), (a, x) -> array_append(a, element_at(a, -1) + x)), 2, {_CHUNK})"
    return f"flatten(transform({before}, (b, k) -> {within}))"


def located(docs: DataFrame, pattern: str, name: str, wanted: Column) -> DataFrame:
    """Adds ``name``: array of (s, e, v, before, after, line) of all matches; empty where ``wanted`` is false.

    ``before`` and ``after`` reach to the next match, or as far as ``_NEAR``
    code points where these hold more whole words than patterns look at; where
    a match comes next, ``OTHER`` stands for it (with the mark it ends in).
    ``line`` is the length of the line before the match, from the match before at most.
    """
    p = _quoted(pattern)
    some = docs.withColumn("_want", wanted).withColumn(
        "_m", F.expr(f"CASE WHEN _want THEN regexp_extract_all(text, {p}, 0) ELSE array() END")).withColumn(
        "_g", F.expr(f"CASE WHEN size(_m) > 0 THEN split(text, {p}, -1) ELSE array('') END"))
    some = some.withColumn("_step", F.expr("transform(_m, (m, i) -> CAST(length(m) + length(_g[i]) AS BIGINT))"))
    some = some.withColumn("_end", F.expr(f"CASE WHEN size(_m) = 0 THEN CAST(array() AS ARRAY<BIGINT>) ELSE {_running('_step')} END"))
    before = f"CASE WHEN size(split(right(_g[i], {_NEAR}), r'[{WS}]+')) > 4 THEN right(_g[i], {_NEAR}) ELSE concat({_other('i - 1', 'get(_m, i - 1)', ' ')}, _g[i]) END"
    after = f"CASE WHEN size(split(left(_g[i + 1], {_NEAR}), r'[{WS}]+')) > 4 THEN left(_g[i + 1], {_NEAR}) ELSE concat(_g[i + 1], {_other('size(_m) - 2 - i', '', '')}) END"
    spans = ("transform(_m, (m, i) -> named_struct('s', _end[i] - length(m), 'e', _end[i], 'v', m, "
             f"'before', {before}, 'after', {after}, 'line', length(substring_index(_g[i], '\n', -1))))")
    return some.withColumn(name, F.expr(spans)).drop("_want", "_m", "_g", "_step", "_end")
