"""Relation paths in export definitions (P3 inside P1 and P2).

A definition names fields of related records in its column list and its
filter, ``customer__cr.nation__cr.name__v``: each part but the last is a
foreign key of the object reached so far.  :func:`resolve_export` turns such a
definition into one plan:

* every relation met in the column list or the filter is one left join,
  however many paths go through it, and its parent holds its key and the
  fields that the definition names, nothing else;
* a condition of the filter that only looks through one relation, which
  nothing else uses, becomes a left semi join with the filtered parent.  That
  holds only for conditions that a record without parent cannot meet; others
  (``x__cr.y IS NULL``) stay filters over the left join;
* all else is left to Catalyst, which turns a left join under a filter that
  rejects nulls into an inner join and pushes the filter into the parent.

Paths are read from the filter by Spark's own SQL parser.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftkit.functions.names import col
from shiftkit.operators.project import mark_ignored, where_filter


@dataclass(frozen=True)
class Relation:
    """A foreign key ``fk`` of an object, to field ``key`` of object ``parent``.

    A path may call it by ``name``; without one by the key itself or, as
    usual, by the key with ``r`` appended (``x__c`` -> ``x__cr``).
    """

    fk: str
    parent: str
    key: str = "id"
    name: str | None = None

    def called(self, part: str) -> bool:
        return part in ((self.name,) if self.name else (self.fk, self.fk + "r"))


Relations = Mapping[str, Sequence[Relation]]
ReadObject = Callable[[str], DataFrame]


def relations_of(rows: DataFrame) -> dict[str, list[Relation]]:
    """Relations from a catalogue table ``object, fk, parent`` (optional ``key``, ``name``): configuration-sized."""
    out: dict[str, list[Relation]] = {}
    for r in rows.collect():
        d = r.asDict()
        out.setdefault(d["object"], []).append(Relation(d["fk"], d["parent"], d.get("key") or "id", d.get("name")))
    return out


def _find(relations: Relations, obj: str, part: str, path: str) -> Relation:
    for r in relations.get(obj, ()):
        if r.called(part):
            return r
    raise ValueError(f"unknown relationship {part} of {obj} in {path}")


# --- reading paths out of a filter ------------------------------------------------

def _parsed(spark: SparkSession, where: str):
    return spark._jsparkSession.sessionState().sqlParser().parseExpression(where)


def _conditions(expression) -> list:
    """The conditions that a filter joins by AND."""
    if expression.getClass().getSimpleName() == "And":
        return _conditions(expression.left()) + _conditions(expression.right())
    return [expression]


def _paths(expression) -> list[tuple[str, ...]]:
    leaves = expression.collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "UnresolvedAttribute":
            parts = leaf.nameParts()
            out.append(tuple(parts.apply(j) for j in range(parts.size())))
    return out


# --- the tree of relations that a definition goes through -----------------------------

@dataclass
class _Node:
    """An object reached, the fields wanted of it, and the relations followed from it."""

    obj: str
    fields: set[str] = field(default_factory=set)
    children: dict[Relation, _Node] = field(default_factory=dict)
    heads: dict[Relation, set[str]] = field(default_factory=dict)          # how paths of the filter call a relation

    def add(self, relations: Relations, path: Sequence[str], filtered: bool = False) -> None:
        node = self
        for part in path[:-1]:
            r = _find(relations, node.obj, part, ".".join(path))
            if filtered:
                node.heads.setdefault(r, set()).add(part)
            node = node.children.setdefault(r, _Node(r.parent))
        node.fields.add(path[-1])


def _joined(df: DataFrame, node: _Node, read_object: ReadObject) -> tuple[DataFrame, dict[Relation, str]]:
    """``df`` with one struct column for each relation followed, and the columns' names."""
    names = {}
    for i, (r, child) in enumerate(node.children.items()):
        names[r] = f"__{r.fk}_{i}"
        parent = _frame(child, r, read_object).withColumnRenamed("__key", f"__key_{i}").withColumnRenamed("__row", names[r])
        df = df.join(parent, col(r.fk) == F.col(f"__key_{i}"), "left").drop(f"__key_{i}")
    return df, names


def _frame(node: _Node, relation: Relation, read_object: ReadObject) -> DataFrame:
    """``__key`` and ``__row`` of the parents: the fields wanted, and in turn the rows that they point to."""
    table = read_object(node.obj)
    missing = [f for f in sorted(node.fields) if f not in table.columns]
    if missing:
        raise ValueError(f"{node.obj} has no field {missing}")
    table = table.select(*[col(c) for c in dict.fromkeys([relation.key, *sorted(node.fields), *(r.fk for r in node.children)])])
    table, names = _joined(table, node, read_object)
    row = [col(f).alias(f) for f in sorted(node.fields)]
    for r, name in names.items():
        heads = sorted(node.heads.get(r, ())) or [r.name or r.fk + "r"]
        clash = [h for h in heads if h in node.fields]
        if clash:
            raise ValueError(f"{clash} is both a field of {node.obj} and a relation followed from it")
        row += [F.col(name).alias(h) for h in heads]
    return table.select(col(relation.key).alias("__key"), F.struct(*row).alias("__row"))


def _rejects_nulls(condition: str, frame: DataFrame, head: str) -> bool:
    """Whether ``condition`` fails for a record that has no parent."""
    kind = frame.schema["__row"].dataType
    spark = frame.sparkSession
    one = spark.range(1).select(F.lit(None).cast(kind).alias(head))
    return one.where(F.expr(condition)).isEmpty()


def resolve_export(table: DataFrame, obj: str, read_object: ReadObject, relations: Relations,
                   where: str | None = None, columns: Iterable[str] | None = None,
                   ignore_columns: Sequence[str] | None = None) -> DataFrame:
    """One export definition with relation paths over ``table``, the rows of ``obj``.

    Columns come out in the given order under the paths' own names; columns of
    ``ignore_columns`` are marked.  No columns: the table's own.  A record
    whose key is null or points nowhere keeps nulls; parents are taken to be
    unique by their key.  A dotted name that ``table`` itself holds as a
    column is that column.  An unknown relationship or field raises.
    """
    spark = table.sparkSession
    columns = list(columns or table.columns)
    own = set(table.columns)
    tree, semi, rest = _Node(obj), [], []
    for c in columns:
        if c not in own and "." in c:
            tree.add(relations, c.split("."))
        elif c not in own:
            raise ValueError(f"columns not in the table: {[c]}")
    conditions = [] if where is None or not where.strip() else _conditions(_parsed(spark, where))

    def followed_path(p: tuple[str, ...]) -> bool:
        return len(p) > 1 and ".".join(p) not in own and (p[0] not in own or any(r.called(p[0]) for r in relations.get(obj, ())))

    looked = [(e.sql(), [p for p in _paths(e) if followed_path(p)], _paths(e)) for e in conditions]
    followed = [{_find(relations, obj, p[0], ".".join(p)) for p in paths} for _, paths, _ in looked]
    for i, (text, paths, every) in enumerate(looked):
        alone = len(followed[i]) == 1 and len(paths) == len(every) and len({p[0] for p in paths}) == 1
        r = next(iter(followed[i])) if alone else None
        if r is None or r in tree.children or any(r in f for j, f in enumerate(followed) if j != i):
            rest.append((text, paths))
            continue
        node = _Node(r.parent)
        for p in paths:
            node.add(relations, p[1:], filtered=True)
        frame = _frame(node, r, read_object)
        if _rejects_nulls(text, frame, paths[0][0]):
            semi.append((r, frame.withColumnRenamed("__row", paths[0][0]).where(F.expr(text)).select("__key")))
        else:
            rest.append((text, paths))
    for _, paths in rest:
        for p in paths:
            tree.add(relations, p, filtered=True)

    for r, keys in semi:
        table = table.join(keys, col(r.fk) == F.col("__key"), "left_semi")
    df, names = _joined(table, tree, read_object)
    # The filter's paths are struct accesses; a key called like its relation steps aside for it.
    aside = {}
    for r, heads in tree.heads.items():
        for h in sorted(heads):
            if h in own:
                if any(p == (h,) for _, _, every in looked for p in every):
                    raise ValueError(f"{h} is both a column and a relation in the filter: call the relation {r.fk}r")
                aside[h] = f"__own_{h}"
                df = df.withColumnRenamed(h, aside[h])
            df = df.withColumn(h, F.col(names[r]))
    for text, _ in rest:
        df = where_filter(df, text)

    def value(c: str):
        if c in own:
            return col(aside.get(c, c)).alias(c)
        node, at, parts = tree, None, c.split(".")
        for part in parts[:-1]:
            r = _find(relations, node.obj, part, c)
            if at is None:
                at = F.col(names[r])
            else:
                heads = sorted(node.heads.get(r, ())) or [r.name or r.fk + "r"]
                at = at.getField(heads[0])
            node = node.children[r]
        return at.getField(parts[-1]).alias(c)

    return mark_ignored(df.select(*[value(c) for c in columns]), ignore_columns)
