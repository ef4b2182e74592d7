"""Bill-of-materials explosion, in an annual and a monthly reading.

Both walk from each finished material (FIN) down to every produced material
beneath it and attach that material's own component rows. They differ on
purpose: the annual reading walks within a plant, counts every month of a year
and states the FIN's quantity for the whole year; the monthly reading walks
across plants, counts only months in which the FIN itself was produced and adds
the FIN's quantity up over the matching rows.

Component rows are summed before they meet the trees. Every row of one
(material, component, period) joins the same FINs, so this changes no total, and
it leaves a hot material one row per component and period. The sums are stored and
also feed the walk, so the fact table itself is read twice in either reading.

An explosion has far more rows than its facts. Its trees are dealt to parts in the order of
their FINs, and each part gets one copy of the sums that its trees need; the
explosion is made, summed up or sorted within the parts, and none of its rows moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.closure import reachable
from millrace.operators.matching import with_match
from millrace.operators.parts import Parts
from millrace.session import materialise

FINISHED = "FIN"
# Fixed value: levels after which a reader that walks along cycles has to stop. Pass it as
# ``max_depth`` to leave out what lies deeper; the walk here ends by itself.
GUARD_DEPTH = 20

PRODUCED_ATTRIBUTES = ["produced_material_release_type", "produced_material_production_type"]
COMPONENT_ATTRIBUTES = ["component_material_release_type", "component_material_production_type"]

# The columns of an explosion, in their order.
EXPLOSION = [
    "plant", "fin_material_id", "fin_material_release_type", "fin_material_production_type", "fin_production_quantity",
    "prod_material_id", "prod_material_release_type", "prod_material_production_type",
    "prod_material_production_quantity", "component_id", "component_material_release_type",
    "component_material_production_type", "component_consumption_quantity", "year",
]
EXPLOSION_SUMS = [c for c in EXPLOSION if c.endswith("_quantity")]
EXPLOSION_KEYS = [c for c in EXPLOSION if c not in EXPLOSION_SUMS]
# What the columns are called while the trees are walked, where that differs.
WALKED = {
    "plant": "plant_id",
    "prod_material_id": "material_id",
    "prod_material_release_type": "produced_material_release_type",
    "prod_material_production_type": "produced_material_production_type",
    "component_id": "component_material",
}


def produced_materials(bom: DataFrame) -> DataFrame:
    """Materials produced anywhere."""
    return bom.select(F.col("produced_material").alias("material_id")).distinct()


def fin_materials(bom: DataFrame) -> DataFrame:
    """Finished materials."""
    return (
        bom.where(F.col("produced_material_release_type") == FINISHED)
        .select(F.col("produced_material").alias("fin_id"))
        .distinct()
    )


def produced_edges(rows: DataFrame, by_plant: bool, produced: DataFrame | None = None) -> DataFrame:
    """Distinct ``src`` to ``dst`` edges of ``rows`` whose component is produced.

    ``produced`` are the materials produced anywhere, by default in ``rows``.
    """
    scope = ["plant_id"] if by_plant else []
    edges = rows.select(
        *scope, F.col("produced_material").alias("src"), F.col("component_material").alias("dst")
    ).distinct()
    made = materialise(produced_materials(rows)) if produced is None else produced
    # Not broadcast: the materials grow with the rows, and a driver would hold them all.
    return with_match(edges, made.withColumnRenamed("material_id", "dst").hint("merge"), "dst")


def fin_members(
    bom: DataFrame, by_plant: bool, max_depth: int | None, fins: DataFrame | None = None
) -> DataFrame:
    """Distinct ``(plant_id,) fin_id, material_id``: the tree below each FIN.

    ``fins`` are the finished materials, by default those of ``bom``.
    """
    scope = ["plant_id"] if by_plant else []
    produced = materialise(produced_materials(bom))
    edges = materialise(produced_edges(bom, by_plant, produced))
    if by_plant:
        # Only rows that are themselves marked finished start a tree.
        anchors = produced_edges(bom.where(F.col("produced_material_release_type") == FINISHED), by_plant, produced)
    else:
        # Any row of a material that is finished somewhere starts a tree.
        fins = materialise(fin_materials(bom)) if fins is None else fins
        anchors = with_match(edges, fins.withColumnRenamed("fin_id", "src"), "src")
    seeds = anchors.select(*scope, F.col("src").alias("root"), F.col("dst").alias("node"))
    tree = reachable(edges, seeds, scope, max_depth, prepared=True)
    return tree.select(*scope, F.col("root").alias("fin_id"), F.col("node").alias("material_id"))


def fin_quantity(bom: DataFrame) -> DataFrame:
    """Quantity of each FIN per plant and year; a quantity repeated in a month counts once."""
    return (
        bom.where(F.col("produced_material_release_type") == FINISHED)
        .select("plant_id", F.col("produced_material").alias("fin_id"), "year", "month", "produced_material_quantity")
        .distinct()
        .groupBy("plant_id", "fin_id", "year")
        .agg(F.sum("produced_material_quantity").alias("fin_production_quantity"))
    )


def fin_attr(bom: DataFrame) -> DataFrame:
    """Release and production types of each FIN per plant."""
    return (
        bom.where(F.col("produced_material_release_type") == FINISHED)
        .select(
            "plant_id",
            F.col("produced_material").alias("fin_id"),
            F.col("produced_material_release_type").alias("fin_material_release_type"),
            F.col("produced_material_production_type").alias("fin_material_production_type"),
        )
        .distinct()
    )


def fin_attributes(bom: DataFrame, fins: DataFrame | None = None) -> DataFrame:
    """Types and quantities of each FIN per plant, year and month.

    ``fins`` are the finished materials, by default those of ``bom``.
    """
    fins = materialise(fin_materials(bom)) if fins is None else fins
    # Distinct before the match: a FIN's many component rows collapse ahead of that shuffle.
    rows = bom.select(
        "plant_id",
        "year",
        "month",
        F.col("produced_material").alias("fin_material_id"),
        F.col("produced_material_release_type").alias("fin_material_release_type"),
        F.col("produced_material_production_type").alias("fin_material_production_type"),
        F.col("produced_material_quantity").alias("fin_production_quantity"),
    ).distinct()
    return with_match(rows, fins.withColumnRenamed("fin_id", "fin_material_id"), "fin_material_id").select(rows.columns)


def component_totals(bom: DataFrame, period: list[str]) -> DataFrame:
    """Component rows summed per plant, period, produced material and component."""
    return bom.groupBy(
        "plant_id", *period, "produced_material", *PRODUCED_ATTRIBUTES, "component_material", *COMPONENT_ATTRIBUTES
    ).agg(
        F.sum("produced_material_quantity").alias("produced_total"),
        F.sum("component_material_quantity").alias("component_total"),
        F.count(F.lit(1)).alias("rows"),
    )


def _named(names: list[str]) -> list[Column]:
    return [F.col(WALKED.get(c, c)).alias(c) for c in names]


def bom_explosion_annual(bom: DataFrame, max_depth: int | None = None, ordered: bool = True) -> DataFrame:
    """Annual explosion: one row per FIN, tree member, component, plant and year.

    ``ordered`` sorts by plant, FIN, member, component and year: each partition is in
    order, and so are the partitions one after the other.
    """
    totals = materialise(component_totals(bom, ["year"]))
    members = fin_members(totals, by_plant=True, max_depth=max_depth)
    finished = materialise(fin_quantity(bom).join(fin_attr(totals), ["plant_id", "fin_id"]))
    parts = Parts(members, ["plant_id", "fin_id", "material_id"], finished.select("plant_id", "fin_id"))
    below = parts.copies(totals.withColumnRenamed("produced_material", "material_id"), ["plant_id", "material_id"])
    years = parts.copies(finished, ["plant_id", "fin_id"])
    # Plant, FIN, member, component and year identify a row here, attributes
    # included, so no aggregate is left to do after the joins.
    exploded = (
        parts.pairs()
        .join(below.hint("merge"), ["part", "plant_id", "material_id"])
        .join(years.hint("shuffle_hash"), ["part", "plant_id", "fin_id", "year"])
        .withColumnsRenamed(
            {
                "fin_id": "fin_material_id",
                "produced_total": "prod_material_production_quantity",
                "component_total": "component_consumption_quantity",
            }
        )
    )
    if ordered:
        exploded = exploded.sortWithinPartitions("at", "component_material", "year")
    return exploded.select(*_named(EXPLOSION))


def bom_explosion_monthly(bom: DataFrame) -> DataFrame:
    """Monthly explosion: quantities of the months in which the FIN was produced, per year."""
    totals = materialise(component_totals(bom, ["year", "month"]))
    fins = materialise(fin_materials(totals))
    members = fin_members(totals, by_plant=False, max_depth=None, fins=fins)
    finished = materialise(
        fin_attributes(bom, fins)
        .groupBy(
            "plant_id", "year", "month", "fin_material_id", "fin_material_release_type", "fin_material_production_type"
        )
        .agg(
            F.sum("fin_production_quantity").alias("fin_total"),
            F.count(F.lit(1)).alias("fin_rows"),
        )
    )
    members = members.withColumnRenamed("fin_id", "fin_material_id")
    parts = Parts(members, ["fin_material_id", "material_id"], finished.select("fin_material_id"))
    below = parts.copies(totals.withColumnRenamed("produced_material", "material_id"), ["material_id"])
    # Where plant, year or month is null, it matches null.
    period = ["plant_id", "year", "month"]
    months = parts.copies(finished, ["fin_material_id"]).withColumnsRenamed({c: f"fin_{c}" for c in ["part", *period]})
    months = months.withColumnRenamed("fin_material_id", "fin_id")
    same = (F.col("part") == F.col("fin_part")) & (F.col("fin_material_id") == F.col("fin_id"))
    for c in period:
        same &= F.col(c).eqNullSafe(F.col(f"fin_{c}"))
    matched = parts.pairs().join(below.hint("merge"), ["part", "material_id"]).join(months.hint("shuffle_hash"), same)
    # Each of fin_rows FIN entries met each of rows component rows.
    met = {
        "fin_production_quantity": F.col("fin_total") * F.col("rows"),
        "prod_material_production_quantity": F.col("produced_total") * F.col("fin_rows"),
        "component_consumption_quantity": F.col("component_total") * F.col("fin_rows"),
    }
    sums = [F.coalesce(F.sum(met[c]), F.lit(0)).alias(c) for c in EXPLOSION_SUMS]
    # All rows of a FIN and member are in one part, which sums them up by itself.
    return matched.groupBy("part", *_named(EXPLOSION_KEYS)).agg(*sums).select(*EXPLOSION)


def register_annual_view(bom: DataFrame, name: str = "bom_explosion") -> DataFrame:
    """Annual explosion registered as a temporary view."""
    exploded = bom_explosion_annual(bom)
    exploded.createOrReplaceTempView(name)
    return exploded
