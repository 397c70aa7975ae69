"""NPI <-> licence matching (JOIN2-JOIN4, WIN2, SET4).

Semantics (the warehouse model): candidates are NPI individuals in the same
block (soundex first name, soundex last name, state); each pair is scored
95 exact name + city / 90 exact name + ZIP / 85 soundex + city / 80 soundex +
ZIP / 70 block only; the best pair per licence wins (confidence desc, NPI
asc) and licences without a candidate are kept with confidence 0.

Execution: scoring every pair of a block is quadratic in the block, and a
common surname in a big state is one huge block. But "best tier, then lowest
NPI" only needs, per tier, the lowest NPI among the NPI rows that share the
licence's tier key. So both sides are expanded to one row per tier key (5
tiers share one key layout), the NPI side is *pre-aggregated by (tier, key)*
(``min(npi)``, a hash aggregate that combines map-side), and ONE equi-join
gives each licence at most one partner per tier; a final per-licence ``min``
picks the best tier; attributes are fetched for the chosen NPIs only. Nothing is emitted per pair, a hot surname collapses to one
NPI row per key before any shuffle; the NPI file is read once for the keys and once
for the chosen rows. The
result is identical to the all-pairs form (the DuckDB oracle runs that
form). AQE broadcasts a candidate table that turns out small and splits
skewed licence partitions of the block-only tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import refdata

NPI_FIELDS = ["npi_number", "npi_first_name", "npi_last_name", "npi_city", "npi_state", "npi_zip5", "npi_phone"]

# FIXED VALUES: (confidence, match type, key columns) in tier order.
TIERS = [
    (95, "exact_name_city_state", ["first_name", "last_name", "state", "city"]),
    (90, "exact_name_zip", ["first_name", "last_name", "state", "zip5"]),
    (85, "soundex_name_city_state", ["first_sx", "last_sx", "state", "city"]),
    (80, "soundex_name_zip", ["first_sx", "last_sx", "state", "zip5"]),
    (70, "soundex_name_state", ["first_sx", "last_sx", "state"]),
]
BLOCK = ["first_sx", "last_sx", "state"]


def npi_match_side(npi_raw: DataFrame) -> DataFrame:
    """FLT3: individual, active, dental/hygiene taxonomy; upper-trimmed names, soundex keys."""
    df = npi_raw.filter(F.col("taxonomy_code").isin(*refdata.MATCH_TAXONOMY_CODES)
                        & (F.col("entity_type_code") == "1") & C.is_blank("deactivation_date"))
    return df.select(
        F.col("npi").cast("string").alias("npi_number"),
        F.upper(F.trim("first_name")).alias("first_name"),
        F.upper(F.trim("last_name")).alias("last_name"),
        C.soundex_key("first_name").alias("first_sx"), C.soundex_key("last_name").alias("last_sx"),
        F.upper(F.trim("practice_city")).alias("city"), F.upper(F.trim("practice_state")).alias("state"),
        C.zip5("practice_zip").alias("zip5"), F.col("practice_phone").alias("phone"))


def license_match_side(licenses: DataFrame) -> DataFrame:
    """SET2 input: staged licences (any types), upper-trimmed names, soundex keys."""
    return licenses.select(
        "professional_id", "state_code", "license_number", "professional_type",
        F.upper(F.trim("first_name")).alias("first_name"), F.upper(F.trim("last_name")).alias("last_name"),
        C.soundex_key("first_name").alias("first_sx"), C.soundex_key("last_name").alias("last_sx"),
        F.upper(F.trim("city")).alias("city"), F.upper(F.trim("address_state")).alias("state"),
        C.zip5("zip_code").alias("zip5"), F.upper(F.trim("county")).alias("county"),
        *(["npi_key"] if "npi_key" in licenses.columns else []))


# Optional first tier (decision D3): the licence record carries the NPI itself.
NPI_TIER = (100, "exact_npi", ["npi_key"])


def _tier_rows(df: DataFrame, payload: list[str], tiers=TIERS) -> DataFrame:
    """One row per tier whose key components are all present: (tier, k1, k2, k3, k4, payload...).

    Keys of different tiers share one column layout (tier 70 has three
    components; its k4 is ''), so every tier is served by ONE equi-join.
    """
    rows = []
    for rank, (_, _, keys) in enumerate(tiers):
        comps = [F.col(k) for k in keys] + [F.lit("")] * (4 - len(keys))
        present = None
        for k in keys:
            c = F.col(k).isNotNull()
            present = c if present is None else present & c
        # Name tiers need the block: both soundex keys present (the NPI tier does not).
        if keys != NPI_TIER[2]:
            present = present & F.col("first_sx").isNotNull() & F.col("last_sx").isNotNull()
        rows.append(F.when(present, F.struct(F.lit(rank).alias("tier"), *[c.alias(f"k{i}") for i, c in enumerate(comps)])))
    keyed = df.select(*payload, F.filter(F.array(*rows), lambda x: x.isNotNull()).alias("_tiers"))
    return keyed.select(*payload, F.explode_outer("_tiers").alias("t")).select(*payload, "t.*")


def _usable_npi(c: str):
    return F.coalesce(F.col(c).rlike("^[0-9]{1,10}$"), F.lit(False))


def unusable_npis(npi_raw: DataFrame) -> DataFrame:
    """Registry rows the match cannot use: their NPI is missing or no number of at most 10 digits (counted by text)."""
    npi = npi_raw.select(F.trim(F.col("npi").cast("string")).alias("npi"))
    return npi.filter(~_usable_npi("npi")).groupBy("npi").agg(F.count(F.lit(1)).alias("rows"))


_TIER_SCALE = 10 ** 10  # NPIs are 10-digit numbers: tier * scale + npi orders by (tier, npi)


def best_match(licenses: DataFrame, npi_raw: DataFrame, npi_on_license_col: str | None = None) -> DataFrame:
    """JOIN3 + JOIN4 + WIN2 + SET4: one row per licence with its best NPI candidate (or no_match).

    Plan: NPI rows -> one row per tier key -> ``min(npi)`` per (tier, key);
    licences -> one row per tier key; ONE left equi-join on (tier, key);
    ``min(tier * 1e10 + npi)`` per licence picks the first tier with a
    candidate and, in it, the lowest NPI. Both aggregates have fixed-width
    buffers, so they run as hash aggregates with map-side combine (a sort-based
    struct aggregate over the 5x expanded registry was 3x slower at 9.2 M
    rows). The NPI attributes are then fetched only for the chosen NPIs.
    Nothing is emitted per candidate pair.
    """
    tiers = ([NPI_TIER] + TIERS) if npi_on_license_col else TIERS
    if npi_on_license_col:
        licenses = licenses.withColumn("npi_key", F.trim(F.col(npi_on_license_col).cast("string")))
    lic = license_match_side(licenses)
    npi = npi_match_side(npi_raw).withColumn("npi_long", F.col("npi_number").try_cast("long")) \
        .withColumn("npi_key", F.col("npi_number"))
    npi_keys = _tier_rows(npi.filter(_usable_npi("npi_number")),
                          ["npi_long", "first_name", "last_name", "city", "state", "zip5", "first_sx", "last_sx",
                           "npi_key"], tiers)
    cand = npi_keys.filter(F.col("tier").isNotNull()).groupBy("tier", "k0", "k1", "k2", "k3") \
        .agg(F.min("npi_long").alias("m"))
    lic_cols = ["professional_id", "state_code", "license_number", "professional_type", "first_name", "last_name",
                "city", "state", "zip5", "first_sx", "last_sx"] + (["npi_key"] if npi_on_license_col else [])
    j = _tier_rows(lic, lic_cols, tiers) \
        .join(cand, ["tier", "k0", "k1", "k2", "k3"], "left")
    code = F.when(F.col("m").isNotNull(), F.col("tier").cast("long") * _TIER_SCALE + F.col("m"))
    best = j.groupBy(*lic_cols).agg(F.min(code).alias("_b")).select(
        *lic_cols, (F.col("_b") / _TIER_SCALE).cast("int").alias("_tier"),
        (F.col("_b") % _TIER_SCALE).alias("npi_long"))
    # The attributes are those of the registry row that matched: of the chosen NPI's rows, the least one whose
    # key of the winning tier agrees. Unmatched licences get a key of their own each (NULL would be one hot partition).
    fields = ["npi_number", "first_name", "last_name", "city", "state", "zip5", "phone"]
    rows = npi.select(F.col("npi_long").alias("_n"), *[F.col(c).alias(f"n_{c}") for c in fields + ["first_sx", "last_sx", "npi_key"]])
    none = -F.pmod(F.xxhash64("professional_id"), F.lit(_TIER_SCALE)) - 1
    agree = []
    for _, _, keys in tiers:
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(k) == F.col(f"n_{k}"))
        agree.append(same)
    found = F.struct(*[F.col(f"n_{c}").alias(c) for c in fields])
    out = (best.join(rows, F.coalesce("npi_long", none) == F.col("_n"), "left").groupBy(*lic_cols, "_tier")
           .agg(F.min(F.when(F.get(F.array(*agree), F.col("_tier")), found)).alias("m")))
    conf = F.lit(0)
    mtype = F.lit("no_match")
    for rank, (score, name, _) in reversed(list(enumerate(tiers))):
        conf = F.when(F.col("_tier") == rank, F.lit(score)).otherwise(conf)
        mtype = F.when(F.col("_tier") == rank, F.lit(name)).otherwise(mtype)
    m = F.col("m")
    scored = out.select(
        "professional_id", "state_code", "license_number", "professional_type",
        F.col("first_name").alias("lic_first_name"), F.col("last_name").alias("lic_last_name"),
        F.col("city").alias("lic_city"), F.col("state").alias("lic_state"), F.col("zip5").alias("lic_zip5"),
        m.npi_number.alias("npi_number"), m.first_name.alias("npi_first_name"),
        m.last_name.alias("npi_last_name"), m.city.alias("npi_city"), m.state.alias("npi_state"),
        m.zip5.alias("npi_zip5"), m.phone.alias("npi_phone"),
        conf.alias("match_confidence"), mtype.alias("match_type"))
    c = F.col("match_confidence")
    return scored.select(
        "*",
        F.when(c >= 90, False).when(c >= 70, True).otherwise(False).alias("needs_manual_review"),
        (c >= 85).alias("auto_approve_for_email"),
        (c >= 95).alias("auto_approve_for_mail"))


def match_candidates(licenses: DataFrame, npi_raw: DataFrame, k: int = 5) -> DataFrame:
    """JOIN2: the first ``k`` candidates of each licence (best tier, then lowest NPI), for manual review.

    No pair of a block is emitted: each (tier, key) is reduced to its ``k`` lowest NPIs, first in every task and then in
    all (a group limit on both sides of the shuffle, so a hot block sends ``k`` rows per task), and a licence meets at most
    ``k`` rows in each of its tiers. That is enough: if the better tiers hold fewer than ``k`` candidates, these are the only ones
    that a worse tier's ``k`` lowest can repeat. Licences without a candidate have no row.
    """
    npi = npi_match_side(npi_raw).filter(_usable_npi("npi_number")).withColumn("npi_long", F.col("npi_number").try_cast("long"))
    by = ["tier", "k0", "k1", "k2", "k3"]
    keys = (_tier_rows(npi, ["npi_long", "first_name", "last_name", "city", "state", "zip5", "first_sx", "last_sx"])
            .where("tier is not null").select(*by, "npi_long").distinct())
    lowest = (keys.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy("npi_long"))).where(F.col("_nth") <= k)
              .groupBy(*by).agg(F.collect_list("npi_long").alias("_npis")))
    own = ["professional_id", "license_number", "professional_type"]
    lic = license_match_side(licenses)
    met = _tier_rows(lic, own + ["first_name", "last_name", "city", "state", "zip5", "first_sx", "last_sx"]).where("tier is not null")
    found = met.join(lowest, by).select(*own, "tier", F.explode("_npis").alias("npi_long"))
    # At most five tiers of k: the best tier of each NPI, and then the first k of these.
    best = found.groupBy(*own, "npi_long").agg(F.min("tier").alias("tier")).groupBy(*own).agg(
        F.slice(F.array_sort(F.collect_list(F.struct("tier", "npi_long"))), 1, k).alias("_first"))
    ranked = best.select(*own, F.posexplode("_first").alias("_at", "c"))
    tier = F.col("c.tier")
    return ranked.select(
        *own, (F.col("_at") + 1).alias("candidate_rank"), F.col("c.npi_long").cast("string").alias("npi_number"),
        F.get(F.array(*[F.lit(score) for score, _, _ in TIERS]), tier).alias("match_confidence"),
        F.get(F.array(*[F.lit(name) for _, name, _ in TIERS]), tier).alias("match_type"),
        F.get(F.array(*[F.lit(score < 90) for score, _, _ in TIERS]), tier).alias("needs_manual_review"))


def candidate_counts(licenses: DataFrame, npi_raw: DataFrame) -> DataFrame:
    """JOIN2: all candidates per licence, counted through the block key.

    Returns the licence keys with ``candidate_count`` (NPI rows in the
    licence's block) — the per-licence work of an all-pairs blocking join —
    without materialising a pair.
    """
    lic = license_match_side(licenses)
    npi = npi_match_side(npi_raw).filter(F.col("first_sx").isNotNull() & F.col("last_sx").isNotNull())
    sizes = npi.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("candidate_count"))
    return lic.join(sizes, BLOCK, "left").select(
        "professional_id", "license_number", "professional_type", *BLOCK,
        F.coalesce("candidate_count", F.lit(0)).cast("bigint").alias("candidate_count"))


def block_histogram(licenses: DataFrame, npi_raw: DataFrame) -> DataFrame:
    """Block-size profile: licences, NPI rows and pair work per block (skew check before matching)."""
    lic = license_match_side(licenses).filter(F.col("first_sx").isNotNull() & F.col("last_sx").isNotNull())
    npi = npi_match_side(npi_raw).filter(F.col("first_sx").isNotNull() & F.col("last_sx").isNotNull())
    a = lic.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("licenses"))
    b = npi.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("npi_rows"))
    return a.join(b, BLOCK, "inner").select(*BLOCK, "licenses", "npi_rows",
                                            (F.col("licenses") * F.col("npi_rows")).alias("pairs"))


def license_entity_to_npi(licenses: DataFrame, npi_raw: DataFrame, lic_col: str = "license_number") -> DataFrame:
    """JOIN18: licence -> the NPI record that lists that licence number for the same state (left join).

    The NPI side is reduced to one row per (licence number, state) — the
    lowest NPI — so a licence never fans out.
    """
    npi = npi_raw.select(F.col("npi").cast("string").alias("npi_number"),
                         F.trim("license_number").alias("npi_license_number"),
                         F.trim("license_state").alias("npi_license_state")) \
        .filter(F.col("npi_license_number").isNotNull() & F.col("npi_license_state").isNotNull()) \
        .groupBy("npi_license_number", "npi_license_state").agg(F.min("npi_number").alias("npi_number"))
    return licenses.join(npi, (F.col(lic_col).cast("string") == F.col("npi_license_number"))
                         & (F.col("state_code") == F.col("npi_license_state")), "left") \
        .drop("npi_license_number", "npi_license_state")
