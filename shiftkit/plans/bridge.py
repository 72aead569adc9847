"""Jobs ``bridge_denormalize`` and ``bridge_rekey`` (survey 3.2).

An N:M bridge table links owners (e.g. units) to tags (e.g. keywords) by id.
Ids differ between instances, business names do not.  ``bridge_denormalize``
turns the source instance's bridge into a blueprint of names;
``bridge_rekey`` maps the blueprint onto the target instance's ids.  Both are
one lazy plan each; the blueprint is not written and read back in between.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftkit.functions.names import col, resolve_columns
from shiftkit.functions.text import business_key, trim_ws
from shiftkit.operators.project import drop_if_present, project_final


@dataclass(frozen=True)
class BridgeSpec:
    """Object and field names of a bridge; defaults follow the sample configs."""

    owner: str = "qms_unit__c"          # bridge column -> owner id
    tag: str = "keyword__c"             # bridge column -> tag id
    name: str = "name__v"               # business name on both dimensions
    tag_type: str = "keyword_type__c"   # second part of the tag's business key
    id_aliases: tuple[str, ...] = ("ignore.id", "id")
    owner_drop: tuple[str, ...] = ("is_valid__c", "state__v")
    tag_drop: tuple[str, ...] = ("state__v",)
    helper: str = "keyword_helper"

    @property
    def owner_id(self) -> str:
        return f"{self.owner}.id"

    @property
    def tag_id(self) -> str:
        return f"{self.tag}.id"

    @property
    def owner_name(self) -> str:
        return f"{self.owner}.{self.name}"

    @property
    def tag_name(self) -> str:
        return f"{self.tag}.{self.name}"


def bridge_denormalize(bridge: DataFrame, owners: DataFrame, tags: DataFrame,
                       spec: BridgeSpec = BridgeSpec(), mapping: dict | None = None) -> DataFrame:
    """J1 + J2 + P7: ``(owner.name, tag.name, tag_type)`` per bridge row.

    Left joins: a dangling or null id gives null names and the row is kept.
    Only the two foreign keys of the bridge and three dimension columns are
    read (column pruning reaches the scans).
    """
    s = spec
    bridge = resolve_columns(bridge, "bridge", [s.tag, s.owner], mapping)
    tags = resolve_columns(tags, "tags", [{"expected": s.tag_id, "aliases": list(s.id_aliases)},
                                          s.name, s.tag_type], mapping)
    owners = resolve_columns(owners, "owners", [{"expected": s.owner_id,
                                                 "aliases": list(s.id_aliases)}, s.name], mapping)
    t = tags.select(col(s.tag_id).alias("__tag_id"), col(s.name).alias(s.tag_name),
                    col(s.tag_type).alias(s.tag_type))
    o = owners.select(col(s.owner_id).alias("__owner_id"), col(s.name).alias(s.owner_name))
    b = bridge.select(col(s.tag).alias("__tag_fk"), col(s.owner).alias("__owner_fk"))
    out = (b.join(t, F.col("__tag_fk") == F.col("__tag_id"), "left")
            .join(o, F.col("__owner_fk") == F.col("__owner_id"), "left"))
    # Exactly these columns, in this order (strict: a missing one raises).
    return project_final(out, [s.owner_name, s.tag_name, s.tag_type])


def _rekey_parts(blueprint: DataFrame, owners: DataFrame, tags: DataFrame,
                 spec: BridgeSpec, mapping: dict | None, key: str, keep_unlinked: bool):
    s = spec
    bp = resolve_columns(blueprint, "blueprint", [s.tag_name, s.tag_type, s.owner_name], mapping)
    owners = resolve_columns(owners, "owners", [{"expected": s.owner_id,
                                                 "aliases": list(s.id_aliases)}, s.name], mapping)
    tags = resolve_columns(tags, "tags", [{"expected": s.tag_id, "aliases": list(s.id_aliases)},
                                          s.name, s.tag_type], mapping)

    # F11 helper: kept in the output as the ignore-column of the reference.
    bp = bp.select(
        col(s.owner_name),
        business_key(col(s.tag_name), col(s.tag_type)).alias(s.helper),
        trim_ws(col(s.tag_name)).alias("__bp_tname"),
        trim_ws(col(s.tag_type)).alias("__bp_ttype"),
    )
    owners = drop_if_present(owners, s.owner_drop)                    # P5
    owner_rest = [c for c in owners.columns if c != s.name]
    # Target owners with their blueprint rows (by business name).  The
    # reference's left join keeps owners without links as one null row; that
    # is an inner join plus the unlinked owners (anti join), so that a name
    # holding a large share of the blueprint stays splittable by AQE (a left
    # join could only split the owner side).
    linked = owners.join(bp, owners[_q(s.name)] == bp[_q(s.owner_name)], "inner")
    joined = drop_if_present(linked, [s.name])
    if keep_unlinked:
        names = bp.select(col(s.owner_name).alias("__bp_owner")).distinct()
        unlinked = owners.join(names, owners[_q(s.name)] == F.col("__bp_owner"), "left_anti")
        joined = joined.unionByName(drop_if_present(unlinked, [s.name]), allowMissingColumns=True)

    tags = drop_if_present(tags, s.tag_drop)
    tag_rest = [c for c in tags.columns if c not in (s.name, s.tag_type)]
    t = tags.select(*[col(c) for c in tag_rest],
                    trim_ws(col(s.name)).alias("__t_name"),
                    trim_ws(col(s.tag_type)).alias("__t_type"),
                    business_key(col(s.name), col(s.tag_type)).alias("__t_helper"))
    if key == "concat":
        cond = joined[_q(s.helper)] == t["__t_helper"]
    else:
        cond = (joined["__bp_tname"] == t["__t_name"]) & (joined["__bp_ttype"] == t["__t_type"])
    # Left join on the composite key (the null filter below makes it inner).
    result = joined.join(t, cond, "left")
    ordered = [*owner_rest, s.owner_name, s.helper, *tag_rest]
    return result.select(*[col(c) for c in ordered]), tag_rest


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bridge_rekey(blueprint: DataFrame, owners: DataFrame, tags: DataFrame,
                 spec: BridgeSpec = BridgeSpec(), mapping: dict | None = None,
                 key: str = "columns") -> DataFrame:
    """J3 + J4 + P9 + P6: the blueprint on the target instance's ids.

    Output columns: ``<owner>`` (target owner id), ``ignore.<owner>.<name>``,
    ``ignore.<helper>``, ``<tag>`` (target tag id), then any further columns
    of the target dimensions.  Rows whose tag does not resolve are absent.
    ``key="columns"`` joins on (stripped name, stripped type); ``"concat"``
    on the ``name_type`` text as the reference does.
    """
    s = spec
    result, _ = _rekey_parts(blueprint, owners, tags, spec, mapping, key, keep_unlinked=False)
    result = result.where(col(s.tag_id).isNotNull())
    renames = {s.tag_id: s.tag, s.owner_id: s.owner,
               s.owner_name: f"ignore.{s.owner_name}", s.helper: f"ignore.{s.helper}"}
    return result.select(*[col(c).alias(renames.get(c, c)) for c in result.columns])


def rekey_coverage(blueprint: DataFrame, owners: DataFrame, tags: DataFrame,
                   spec: BridgeSpec = BridgeSpec(), mapping: dict | None = None,
                   key: str = "columns") -> DataFrame:
    """Matched / total rows after the tag join, in one aggregation."""
    result, _ = _rekey_parts(blueprint, owners, tags, spec, mapping, key, keep_unlinked=True)
    return result.agg(F.count_if(col(spec.tag_id).isNotNull()).alias("matched"),
                      F.count(F.lit(1)).alias("total"))


def bridge_transfer(bridge: DataFrame, owners: DataFrame, tags: DataFrame,
                    target_owners: DataFrame, target_tags: DataFrame,
                    spec: BridgeSpec = BridgeSpec(), mapping: dict | None = None,
                    key: str = "columns") -> DataFrame:
    """``bridge_rekey(bridge_denormalize(...))`` when both instances are at hand.

    Same rows and columns, planned for a large bridge: the name matching is
    done once on the dimensions (source id -> target id maps, dimension
    sized), and the bridge is joined to the two maps by id.  The bridge is
    shuffled twice (once per foreign key) instead of four times, and carries
    ids rather than names through the shuffles.  Unmatched or dangling keys
    drop the row, exactly as the two-step job does.
    """
    s = spec
    bridge = resolve_columns(bridge, "bridge", [s.tag, s.owner], mapping)
    tags = resolve_columns(tags, "tags", [{"expected": s.tag_id, "aliases": list(s.id_aliases)},
                                          s.name, s.tag_type], mapping)
    owners = resolve_columns(owners, "owners", [{"expected": s.owner_id,
                                                 "aliases": list(s.id_aliases)}, s.name], mapping)
    t_owners = resolve_columns(target_owners, "target owners",
                               [{"expected": s.owner_id, "aliases": list(s.id_aliases)}, s.name], mapping)
    t_tags = resolve_columns(target_tags, "target tags",
                             [{"expected": s.tag_id, "aliases": list(s.id_aliases)}, s.name, s.tag_type],
                             mapping)
    # Owner map: source owner id -> target owner row(s), by business name.
    t_owners = drop_if_present(t_owners, s.owner_drop)
    owner_rest = [c for c in t_owners.columns if c != s.name]
    src_o = owners.select(col(s.owner_id).alias("__src_owner"), col(s.name).alias("__src_oname"))
    owner_map = src_o.join(t_owners, F.col("__src_oname") == t_owners[_q(s.name)], "inner") \
        .select("__src_owner", F.col("__src_oname").alias(f"ignore.{s.owner_name}"),
                *[col(c) for c in owner_rest])
    # Tag map: source tag id -> target tag row(s), by (stripped name, stripped type).
    t_tags = drop_if_present(t_tags, s.tag_drop)
    tag_rest = [c for c in t_tags.columns if c not in (s.name, s.tag_type)]
    src_t = tags.select(col(s.tag_id).alias("__src_tag"),
                        business_key(col(s.name), col(s.tag_type)).alias(f"ignore.{s.helper}"),
                        trim_ws(col(s.name)).alias("__sn"), trim_ws(col(s.tag_type)).alias("__st"))
    tt = t_tags.select(*[col(c) for c in tag_rest], trim_ws(col(s.name)).alias("__tn"),
                       trim_ws(col(s.tag_type)).alias("__tt"),
                       business_key(col(s.name), col(s.tag_type)).alias("__th"))
    cond = (F.col(f"`ignore.{s.helper}`") == F.col("__th")) if key == "concat" else \
        ((F.col("__sn") == F.col("__tn")) & (F.col("__st") == F.col("__tt")))
    tag_map = src_t.join(tt, cond, "inner").select(
        "__src_tag", f"`ignore.{s.helper}`", *[col(c).alias(f"__tag__{c}") for c in tag_rest])
    b = bridge.select(col(s.tag).alias("__tag_fk"), col(s.owner).alias("__owner_fk"))
    out = (b.join(tag_map, F.col("__tag_fk") == F.col("__src_tag"), "inner")
            .join(owner_map, F.col("__owner_fk") == F.col("__src_owner"), "inner"))
    renames = {s.owner_id: s.owner, s.tag_id: s.tag}
    return out.select(*[col(c).alias(renames.get(c, c)) for c in owner_rest],
                      col(f"ignore.{s.owner_name}"), col(f"ignore.{s.helper}"),
                      *[col(f"__tag__{c}").alias(renames.get(c, c)) for c in tag_rest])
