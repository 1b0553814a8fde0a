"""The SQL that the manifest is compared with: the levels spelled out one after the other."""

from __future__ import annotations

_LEVELS, _TOPS = 6, 3  # up to 16^6 rows of a source and 16^3 sources

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_CRC_STEP = "CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END"
_CRC = f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda digit: ascii(digit)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda r, k: {_CRC_STEP})))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(name) for name in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _depth(n: str) -> str:
    return "(" + " + ".join(f"({n} > {16**k})::INT" for k in range(_LEVELS)) + ")"


def _rises(name: str, levels: int) -> str:
    """The levels above ``name0`` (part, i, h, depth), the siblings of each, and where each part ends."""
    made = []
    for k in range(levels):
        made.append(f"""{name}{k + 1} AS (SELECT part, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, depth
            FROM {name}{k} WHERE depth > {k} GROUP BY part, i // 16, depth)""")
        made.append(f"""{name}_at{k} AS (SELECT a.part, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
            coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
            FROM {name}{k} AS a JOIN {name}{k} AS b ON a.part = b.part AND a.i // 16 = b.i // 16
            WHERE a.depth > {k} GROUP BY a.part, a.i)""")
    ends = " UNION ALL ".join(f"SELECT part, h FROM {name}{k} WHERE depth = {k}" for k in range(levels + 1))
    return ", ".join([*made, f"{name}_ends AS ({ends})"])


def _climbs(source: str, name: str, part: str, place: str, levels: int) -> str:
    """``source`` (cur, proof, part, place) carried up through the siblings of ``name``."""
    made, before = [], source
    for k in range(levels):
        here = f"{name}_up{k + 1}"
        made.append(f"""{here} AS (SELECT c.* REPLACE (CASE WHEN s.part IS NULL THEN cur ELSE sha256(s.l || cur || s.r) END AS cur,
            proof || coalesce(s.l || s.r, '') AS proof)
            FROM {before} AS c LEFT JOIN {name}_at{k} AS s ON s.part = c.{part} AND s.i = c.{place} // {16**k})""")
        before = here
    return ", ".join(made)


LEVEL_STRINGS = f"""
WITH hashed AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
           CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, {_A_TO_Z})")} END AS altered
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS part
    FROM hashed),
low0 AS (SELECT part, place AS i, leaf AS h, {_depth("n")} AS depth FROM placed),
{_rises("low", _LEVELS)},
top0 AS (SELECT 0 AS part, part AS i, h, {_depth("(SELECT count(*) FROM low_ends)")} AS depth FROM low_ends),
{_rises("top", _TOPS)},
begun AS (SELECT doc_id, leaf, part, place, 0 AS whole, coalesce(altered, leaf) AS cur, '' AS proof FROM placed),
{_climbs("begun", "low", "part", "place", _LEVELS)},
{_climbs(f"low_up{_LEVELS}", "top", "whole", "part", _TOPS)}
SELECT doc_id, leaf, e.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = t.h AS verified
FROM top_up{_TOPS} AS u JOIN low_ends AS e ON e.part = u.part CROSS JOIN top_ends AS t
"""
