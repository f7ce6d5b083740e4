"""Several values packed in one field: one row per value, with its position.

A field is cut at its quote characters: odd pieces are literals, even pieces are looked at for delimiters. A fold over the
pieces writes a masked text in which every enclosed literal is one placeholder; the field's one separator is then chosen and
the masked text is cut there, so that nothing inside a literal can separate. All of it is one native SQL expression, in which every intermediate value is evaluated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONJUNCTIONS = ("always", "list_end", "never")

_WS = r"[\\s\\u00a0\\ufeff]"
_TRIM = rf"^{_WS}+|{_WS}+$"
_OPENS = r"(^|[,;|\\t\\r\\n•·*‣▪]|\\s/|\\d[.)]|\\sand|&)\\s*$"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '{_TRIM}', '')"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


#: struct<out: masked text, lits: literals> of the pieces ``ps`` of a text under the quote character ``q``.
_MASKED = f"""
    aggregate(
      transform(ps, (p, i) -> named_struct('p', p, 'i', i, 'last', i = size(ps) - 1)),
      named_struct('out', cast('' AS string), 'lits', cast(array() AS array<string>), 'closed', false, 'twice', false),
      (a, x) -> CASE
        WHEN x.i % 2 = 0 AND x.p = '' AND x.i > 0 AND NOT x.last AND a.closed
          THEN named_struct('out', a.out, 'lits', a.lits, 'closed', false, 'twice', true)
        WHEN x.i % 2 = 0
          THEN named_struct('out', concat(a.out, x.p), 'lits', a.lits, 'closed', false, 'twice', false)
        WHEN a.twice
          THEN named_struct('out', a.out, 'lits', concat(slice(a.lits, 1, size(a.lits) - 1), array(concat(element_at(a.lits, -1), q, x.p))), 'closed', true, 'twice', false)
        WHEN x.last
          THEN named_struct('out', concat(a.out, q, x.p), 'lits', a.lits, 'closed', false, 'twice', false)
        WHEN a.out RLIKE '{_OPENS}'
          THEN named_struct('out', concat(a.out, '\\uE000', cast(size(a.lits) AS string), '\\uE001'), 'lits', concat(a.lits, array(x.p)), 'closed', true, 'twice', false)
        ELSE named_struct('out', concat(a.out, q, x.p, q), 'lits', a.lits, 'closed', false, 'twice', false)
      END,
      a -> named_struct('out', a.out, 'lits', a.lits))"""


#: Texts that hold the placeholders' own characters: these are written with an escape meanwhile.
_ESCAPES = (("\ue002", "a"), ("\ue000", "b"), ("\ue001", "c"))


def _escaped(x: str) -> str:
    out = x
    for c, mark in _ESCAPES:
        out = f"replace({out}, '{c}', '\ue002{mark}')"
    return f"CASE WHEN {x} RLIKE '[\ue000-\ue002]' THEN {out} ELSE {x} END"


def _unescaped(x: str) -> str:
    out = x
    for c, mark in reversed(_ESCAPES):
        out = f"replace({out}, '\ue002{mark}', '{c}')"
    return f"CASE WHEN contains({x}, '\ue002') THEN {out} ELSE {x} END"


def _cut(m: str, conjunction: str) -> str:
    """SQL: array of the raw items of the masked text ``m``."""
    parts = f"split({m}, ',')"
    filled = f"filter({parts}, x -> trim(x) <> '')"
    if conjunction == "always":
        comma = f"""CASE WHEN size({filled}) = 2 AND NOT exists({filled}, x -> trim(x) RLIKE '[\\\\s\\uE000]') THEN array({m})
          ELSE flatten(transform({parts}, x -> split(x, '(^|\\\\s+)(?:and|&)\\\\s+'))) END"""
        rest = f"split({m}, '\\\\s+(?:and|&)\\\\s+')"
    elif conjunction == "list_end":
        last = f"element_at({filled}, -1)"
        comma = f"""CASE WHEN size({filled}) >= 3 AND {last} RLIKE '^\\\\s*(and|&)\\\\s' OR size({filled}) >= 2 AND {last} RLIKE '\\\\S\\\\s+(and|&)\\\\s+\\\\S'
          THEN concat(slice({filled}, 1, size({filled}) - 1), split({last}, '(^|\\\\s+)(?:and|&)\\\\s+')) ELSE {parts} END"""
        rest = f"array({m})"
    else:
        comma, rest = parts, f"array({m})"
    return rf"""CASE
      WHEN {m} RLIKE '[\\r\\n]' THEN split({m}, '[\\r\\n]+')
      WHEN {m} RLIKE '\\t' THEN split({m}, '\\t+')
      WHEN {m} LIKE '%||%' THEN split({m}, '\\|\\|')
      WHEN {m} LIKE '%|%' THEN split({m}, '\\|')
      WHEN {m} RLIKE '^\\d+[.)]\\s' THEN split({m}, '(?:^|\\s+)\\d+[.)]\\s+')
      WHEN {m} RLIKE '^[•·*‣▪]\\s' THEN split({m}, '(?:^|\\s+)[•·*‣▪]\\s+')
      WHEN {m} RLIKE '\\s/\\s' THEN split({m}, '\\s+/\\s+')
      WHEN {m} LIKE '%;%' THEN split({m}, ';')
      WHEN {m} LIKE '%,%' THEN {comma}
      ELSE {rest} END"""


def unpack(df: DataFrame, keys: list[str], column: str, conjunction: str = "never", pos: str = "pos", item: str = "item", least: int = 2) -> DataFrame:
    """One row per value packed in ``column``: the ``keys``, ``pos`` (from 1, without empty values) and ``item``.

    ``conjunction``: whether a bare "and"/"&" separates: ``always`` (people), ``list_end`` (only at the end of a comma list of
    three or more) or ``never``. Fields with fewer than ``least`` values give no row.

    Defined cases: a null, blank or list-mark-only field gives no row; repeated input rows give repeated output rows; an
    unbalanced quote is ordinary text; a broken JSON list is read as ordinary text; an empty table gives an empty table; other
    columns of ``df`` are ignored, so their names cannot clash; ``pos``/``item`` may not be among the keys (ValueError).
    Length of the text is not bounded; texts may hold any character, the placeholders' own included.
    """
    if conjunction not in CONJUNCTIONS:
        raise ValueError(f"conjunction must be one of {CONJUNCTIONS}")
    if {pos.lower(), item.lower()} & {k.lower() for k in keys} or pos.lower() == item.lower():
        raise ValueError("pos and item need names that no key has")
    keep = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    d = df.select(*keep, F.expr(_trim(f"cast(`{column}` AS string)")).alias("__t")).where("__t <> ''").withColumn("__t", F.expr(_escaped("__t")))
    plain = "named_struct('out', __t, 'lits', cast(array() AS array<string>))"
    quote = r"""CASE WHEN __t RLIKE "^'[\\s\\S]*'$" THEN "'" WHEN __t RLIKE '(^|[,;|\\t\\r\\n•·*‣▪]|\\s/|\\d[.)])\\s*"' THEN '"' END"""
    masked = _let(quote, "q", f"CASE WHEN q IS NULL THEN {plain} ELSE {_let('split(__t, q)', 'ps', _MASKED)} END")
    mark = rf"regexp_replace({_trim('x')}, '^(?:[•·*‣▪]|\\d+[.)])\\s+', '')"
    fold = "aggregate(sequence(0, size(k.lits) - 1), x, (a, i) -> replace(a, concat('\\uE000', cast(i AS string), '\\uE001'), get(k.lits, i)))"
    back = f"CASE WHEN size(k.lits) > 0 AND contains(x, '\\uE000') THEN {fold} ELSE x END"
    tidy = f"transform(transform(transform({_cut('m', conjunction)}, x -> {_trim(mark)}), x -> {back}), x -> {_trim('x')})"
    text = _let(masked, "k", _let(_trim("k.out"), "m", tidy))
    read = "CASE WHEN __t RLIKE '^\\\\[[\\\\s\\\\S]*\\\\]$' THEN from_json(__t, 'array<string>') END"
    values = _let(read, "j", f"CASE WHEN j IS NOT NULL THEN transform(j, x -> {_trim('x')}) ELSE {text} END")
    enough = _let(f"filter({values}, x -> x <> '')", "v", f"CASE WHEN size(v) >= {int(least)} THEN v END")
    return d.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], F.posexplode(F.expr(enough)).alias("__p", "__x")).select(
        *[f"`{k}`" for k in keys], (F.col("__p") + 1).alias(pos), F.expr(_unescaped("__x")).alias(item)
    )
