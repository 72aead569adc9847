"""Joins (survey 2.3): relation paths, bridge resolution, business-key joins.

All joins are equi-joins on declared keys; Catalyst/AQE pick the strategy
(sort-merge by default, broadcast when Spark's size check allows, skew split
for hot keys).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.functions.text import trim_ws


def key_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
             how: str = "left", null_safe: bool = False, trim: bool = False) -> DataFrame:
    """Equi-join on ``(left_col, right_col)`` pairs.

    ``trim`` compares Python-stripped values.  ``null_safe`` makes a null key
    match a null key (pandas ``merge`` behaviour); off by default, since a
    null name is not a link.
    """
    conds = []
    for lname, rname in pairs:
        lc, rc = left[_q(lname)], right[_q(rname)]
        if trim:
            lc, rc = trim_ws(lc), trim_ws(rc)
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return left.join(right, cond, how)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def relation_path(df: DataFrame, fk: str, parent: DataFrame, parent_key: str,
                  fields: Sequence[str], relation: str | None = None) -> DataFrame:
    """Add ``<relation>.<field>`` columns from the row ``fk`` points to.

    0..1 parent per row: a left join on the key.  The parent is reduced to
    its key and the wanted fields before the join, so only those columns are
    read and shuffled.
    """
    rel = relation or (fk + "r" if fk.endswith("__c") or fk.endswith("__v") else fk)
    key_alias = f"__{rel}__key"
    p = parent.select(col(parent_key).alias(key_alias),
                      *[col(f).alias(f"{rel}.{f}") for f in fields])
    out = df.join(p, df[_q(fk)] == p[_q(key_alias)], "left")
    return out.drop(key_alias)


def bridge_resolve(bridge: DataFrame, left_fk: str, left_dim: DataFrame, left_id: str,
                   left_fields: Mapping[str, str], right_fk: str, right_dim: DataFrame,
                   right_id: str, right_fields: Mapping[str, str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """J1 + J2: resolve both foreign keys of an N:M bridge to business fields.

    ``*_fields`` map a dimension column to its output name.  Dimension columns
    are renamed before the joins, so no clashing name needs a suffix.  Both
    joins are left joins: a dangling or null key yields nulls, the bridge row
    stays.  Output: ``keep`` columns of the bridge, then the mapped fields.
    """
    lk, rk = "__left_id", "__right_id"
    ld = left_dim.select(col(left_id).alias(lk), *[col(s).alias(d) for s, d in left_fields.items()])
    rd = right_dim.select(col(right_id).alias(rk), *[col(s).alias(d) for s, d in right_fields.items()])
    b = bridge.select(*[col(c) for c in dict.fromkeys([*keep, left_fk, right_fk])])
    out = b.join(ld, b[_q(left_fk)] == ld[lk], "left")
    out = out.join(rd, out[_q(right_fk)] == rd[rk], "left")
    return out.select(*[col(c) for c in keep], *[col(d) for d in left_fields.values()],
                      *[col(d) for d in right_fields.values()])


#: A pattern's head: at most so many characters of its start. Heads share so many cells, which steer the work, not the result.
HEAD, CELLS = 4, 1 << 16


def _head_cell(head: Column) -> Column:
    return F.pmod(F.xxhash64(head), F.lit(CELLS))


def possible_patterns(items: DataFrame, item_text: str, patterns: DataFrame, pattern_col: str) -> DataFrame:
    """``items`` with ``__pattern``: the distinct substrings of a row's text that may be patterns, a row each.

    A table of at most CELLS rows says which lengths the patterns of a head
    have.  It is broadcast; a text is cut only where a head stands, to the lengths
    of that head, so the rows are few before anything is shuffled.  Every
    pattern that a text contains is among them; others may be, so callers
    join them to the patterns on equality.  Null and empty patterns match nothing.
    """
    p, text = F.col("__p"), col(item_text)
    size = F.least(F.pow(F.lit(2), F.floor(F.log2(F.length(p)))).cast("int"), F.lit(HEAD))
    keyed = patterns.select(col(pattern_col).alias("__p")).where(F.length(p) > 0)
    heads = (keyed.select(size.alias("__q"), F.substring(p, F.lit(1), size).alias("__head"), F.length(p).alias("__n"))
             .groupBy("__q", _head_cell(F.col("__head")).alias("__cell")).agg(F.collect_set("__n").alias("__sizes")))
    sizes = F.array(*[F.lit(1 << i) for i in range(HEAD.bit_length())])
    placed = (items.withColumn("__q", F.explode(sizes)).where(F.col("__q") <= F.length(text))
              .withColumn("__pos", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("__q") + 1)))
              .withColumn("__cell", _head_cell(F.substring(text, F.col("__pos"), F.col("__q")))))
    cut = (placed.join(F.broadcast(heads), ["__q", "__cell"]).withColumn("__n", F.explode("__sizes"))
           .where(F.col("__pos") + F.col("__n") - 1 <= F.length(text))
           .withColumn("__pattern", F.substring(text, F.col("__pos"), F.col("__n"))))
    return cut.where(F.instr(text, F.col("__pattern")) == F.col("__pos")).drop("__q", "__cell", "__sizes", "__pos", "__n")


def substring_pairs(items: DataFrame, item_text: str, patterns: DataFrame, pattern_col: str) -> DataFrame:
    """Each item row with each distinct pattern (``__pattern``) that its text contains.

    One equi-join of :func:`possible_patterns` with the patterns.
    """
    wanted = patterns.select(col(pattern_col).alias("__pattern")).where(F.length("__pattern") > 0).distinct()
    return possible_patterns(items, item_text, patterns, pattern_col).join(wanted, "__pattern").select(*[col(c) for c in items.columns], "__pattern")


def contains_join(items: DataFrame, item_text: str, patterns: DataFrame, pattern_col: str,
                  how: str = "left", pattern_key: Sequence[str] | None = None) -> DataFrame:
    """J9 (substring form): pair each pattern with every item whose text contains it.

    Exact and without a nested loop (:func:`substring_pairs`).  Each
    (pattern, item) pair is returned once.  ``pattern_key``
    (default: the pattern column) identifies a pattern row for the unmatched
    side of ``how="left"``.  Callers that only need a summary per pattern
    should aggregate the pairs before joining (see ``reconcile_imports``).
    """
    pairs = substring_pairs(items, item_text, patterns, pattern_col)
    keys = list(pattern_key or [pattern_col])
    matched = (patterns.join(pairs, col(pattern_col) == F.col("__pattern"), "inner").drop("__pattern")
               .dropDuplicates([*keys, *items.columns]))
    if how == "inner":
        return matched
    # Left form as inner + anti on the (small) matched side: an inner join
    # lets AQE split a hot key on either side, a left outer join only on
    # the pattern side.
    hit = matched.select(*[col(k) for k in keys]).distinct()
    unmatched = patterns.join(hit, keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def composite_key_join(left: DataFrame, left_keys: Sequence[str], right: DataFrame,
                       right_keys: Sequence[str], how: str = "inner",
                       key: str = "columns") -> DataFrame:
    """Join on stripped multi-column business keys.

    ``key="columns"`` compares the stripped parts pairwise (no ambiguity);
    ``key="concat"`` compares the ``a_b`` text key, which also matches
    (``a_b``, ``c``) to (``a``, ``b_c``).
    """
    if key == "concat":
        lk = F.concat_ws("_", *[trim_ws(left[_q(k)]) for k in left_keys])
        rk = F.concat_ws("_", *[trim_ws(right[_q(k)]) for k in right_keys])
        cond = lk == rk
        for k in [*left_keys]:
            cond = cond & left[_q(k)].isNotNull()
        for k in [*right_keys]:
            cond = cond & right[_q(k)].isNotNull()
    else:
        cond = None
        for lk_, rk_ in zip(left_keys, right_keys):
            c = trim_ws(left[_q(lk_)]) == trim_ws(right[_q(rk_)])
            cond = c if cond is None else cond & c
    return left.join(right, cond, how)
