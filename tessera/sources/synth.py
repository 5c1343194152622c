"""Synthetic business records with known truth, every draw by hash: the same rows at any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BRANDS = "acme zenith cobalt onyx ivy summit harbor granite willow beacon copper lantern maple orchid falcon cedar juniper quartz raven sable".split()
KINDS = {"Bakery": "bakery", "Clinic": "medical", "Legal": "legal", "Tailors": "retail", "Bike Shop": "bike", "Hardware": "hardware", "Coffee": "coffee", "Dental": "dental", "Roofing": "roofing", "Florist": "floral"}
CITIES = (("Springfield", "IL", "627"), ("Salt Lake City", "UT", "841"), ("Austin", "TX", "787"), ("Denver", "CO", "802"), ("Portland", "OR", "972"), ("Anchorage", "AK", "995"))
STREETS = "Main Oak Pine Lake Hill Park River Church Mill Spring".split()


def draw(seed: int, tag: str, most: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("entity"), F.lit(tag)), F.lit(most))


def chance(seed: int, tag: str, share: float) -> Column:
    return draw(seed, tag, 1_000_000) < int(share * 1_000_000)


def pick(values, place: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (place % len(values) + 1).cast("int"))


def entities(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    rows = spark.range(n).withColumnRenamed("id", "entity")
    brand, kind, city = draw(seed, "brand", len(BRANDS)), draw(seed, "kind", len(KINDS)), draw(seed, "city", len(CITIES))
    rows = rows.withColumns({"brand": pick(BRANDS, brand), "kind": pick(list(KINDS), kind), "city": pick([c[0] for c in CITIES], city), "state": pick([c[1] for c in CITIES], city), "zip3": pick([c[2] for c in CITIES], city)})
    # A share of entities are twins: the same name at another place.
    return rows.withColumns(
        {
            "name": F.concat_ws(" ", F.initcap("brand"), F.when(chance(seed, "twin", 0.08), F.lit("")).otherwise(F.concat(pick(STREETS, draw(seed, "mid", 10)), (draw(seed, "num", 90)).cast("string"))), "kind"),
            "zip": F.concat("zip3", F.lpad(draw(seed, "zip", 100).cast("string"), 2, "0")),
            "house": (draw(seed, "house", 9800) + 100).cast("string"),
            "street": pick(STREETS, draw(seed, "street", 10)),
            "phone": F.concat(F.lit("217555"), F.lpad(draw(seed, "phone", 10_000).cast("string"), 4, "0")),
        }
    )


def misspelled(col: Column, seed: int, tag: str) -> Column:
    """One letter dropped, or two swapped."""
    at = (draw(seed, f"{tag}-at", 6) + 2).cast("int")
    dropped = F.concat(col.substr(F.lit(1), at - 1), col.substr(at + 1, F.lit(200)))
    swapped = F.concat(col.substr(F.lit(1), at - 1), col.substr(at + 1, F.lit(1)), col.substr(at, F.lit(1)), col.substr(at + 2, F.lit(200)))
    return F.when(chance(seed, f"{tag}-drop", 0.5), dropped).otherwise(swapped)


def source(base: DataFrame, src: int, seed: int, weights: tuple[int, ...], noise: float) -> DataFrame:
    """(entity, id, src, name, address, country, phone): so many listings of an entity as its draw on ``weights`` says."""
    total = sum(weights)
    place, n = draw(seed, f"n{src}", total), F.lit(len(weights) - 1)
    for k in reversed(range(len(weights) - 1)):
        n = F.when(place < sum(weights[: k + 1]), k).otherwise(n)
    rows = base.withColumn("copies", n.cast("int")).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    name = F.when(chance(seed, f"typo{src}", noise), misspelled(F.col("name"), seed, f"typo{src}")).when(chance(seed, f"legal{src}", 0.4), F.concat("name", F.lit(" LLC"))).otherwise(F.col("name"))
    address = F.concat_ws(", ", F.concat_ws(" ", "house", "street", pick(("St", "Street", "Ave"), draw(seed, f"suffix{src}", 3))), "city", F.concat_ws(" ", "state", "zip"))
    blank = pick(("", "N/A", "null", "-"), draw(seed, f"blank{src}", 4))
    return rows.select(
        "entity",
        F.concat(F.lit(f"S{src + 1}-"), "entity", F.lit("-"), "copy").alias("id"),
        F.lit(src).cast("long").alias("src"),
        name.alias("name"),
        F.when(chance(seed, f"gone{src}", noise / 2), blank).otherwise(address).alias("address"),
        F.lit("US").alias("country"),
        "phone",
        "zip",
        "state",
        F.col("kind").alias("category"),
        # About a kilometre around the entity's place.
        (F.lit(30.0) + draw(seed, "lat", 1000) / 50 + draw(seed, f"lat{src}", 100) / 10_000).alias("lat"),
        (F.lit(-100.0) + draw(seed, "lon", 1000) / 50 + draw(seed, f"lon{src}", 100) / 10_000).alias("lon"),
    )


def trapped(base: DataFrame, src: int, seed: int, moved: float = 0.10, mates: float = 0.12) -> DataFrame:
    """Listings that match no entity but look like one: its name at another place, another name at its place."""
    clone = base.where(chance(seed, f"clone{src}", moved)).withColumns({"house": (draw(seed, "clone-house", 9800) + 100).cast("string"), "street": pick(STREETS, draw(seed, "clone-street", 10)), "zip": F.concat(F.lit("9"), F.lpad(draw(seed, "clone-zip", 9999).cast("string"), 4, "0"))})
    mate = base.where(chance(seed, f"mate{src}", mates)).withColumn("name", F.concat_ws(" ", F.initcap(pick(BRANDS, draw(seed, "mate-brand", len(BRANDS)))), F.lit("Annex"), pick(list(KINDS), draw(seed, "mate-kind", len(KINDS)))))
    parts = [source(rows.withColumn("phone", F.concat(F.lit("312555"), F.lpad(draw(seed, tag, 10_000).cast("string"), 4, "0"))), src, seed, (0, 1), 0.0).withColumn("id", F.concat("id", F.lit(f"-{tag}"))) for tag, rows in (("clone", clone), ("mate", mate))]
    return parts[0].unionByName(parts[1])


def generate(spark: SparkSession, n: int = 1200, seed: int = 42, traps: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records of three sources, and truth pairs (s1_id, id, src); with ``traps`` also listings that match nothing."""
    base = entities(spark, n, seed)
    parts = [source(base, 0, seed, (0, 1), 0.0), source(base, 1, seed, (18, 52, 24, 6), 0.15), source(base, 2, seed, (22, 50, 22, 6), 0.25)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    truth = parts[0].select("entity", F.col("id").alias("s1_id")).join(parts[1].unionByName(parts[2]).select("entity", "id", "src"), "entity").select("s1_id", "id", "src")
    if traps:
        rows = rows.unionByName(trapped(base, 1, seed)).unionByName(trapped(base, 2, seed))
    return rows.drop("entity"), truth
