"""Synthetic order documents (A6) and monitoring batches.

One synthetic document per input key row (e.g. every ``orders`` key), so the
volume follows the data.  Every random choice is a uniform derived from
``xxhash64(key, draw-id, seed)`` - reproducible, independent of partitioning,
evaluated inside the JVM with higher-order functions (no Python per row).
Same distributional contract as the original generator, not the same bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES - vocabulary of the original synthetic generator: targets,
# makes, cost centres, the word lists per cost centre, and the phrases,
# makes and cost centres of the monitoring batch.
SYN_TARGETS = ("calibration", "wheelmeasurement", "bodymeasurement", "dismounting", "bodyrepair", "assembly",
               "plasticrepair", "allTiresService", "cleaning", "paintingPreparation", "paintingSpraying",
               "paintingFinish", "hailrepair", "glas")
SYN_MAKES = ("VW", "BMW", "MERCEDES", "AUDI", "FORD", "OPEL", "SKODA", "RENAULT", "MINI", "PORSCHE", "TESLA",
             "TOYOTA")
SYN_COST_CENTERS = ("bodywork", "painting", "paintmaterial", "material", "others")
PAINTING_WORDS = ("LACKIEREN", "BEILACKIEREN", "FARBTON", "ANMISCHEN", "KLARLACK", "VORARBEITEN", "DECKLACK")
BODYWORK_WORDS = ("STOSSFAENGER", "SCHWEISSEN", "RICHTEN", "A+E", "ERSATZ", "VERKLEIDUNG", "KOTFLUEGEL",
                  "SEITENTEIL", "DELLEN", "HAGEL", "FRONT", "AUSTAUSCH")
MATERIAL_WORDS = ("KLEBSTOFF", "SCHRAUBE", "CLIP", "HALTER", "REINIGER", "KLEINMATERIAL", "DICHTMASSE")
MISC_WORDS = ("KALIBRIEREN", "VERMESSEN", "REIFEN", "RAD", "ACHSMESSUNG", "SCHEIBE", "GLAS")
SHORT_TARGETS = ("cleaning", "wheelmeasurement")
MONITOR_PHRASES = ("HAGELSCHADENREPARATUR", "LACKIEREN", "FAHRZEUGREINIGUNG", "KAROSSERIE BLECH RICHTARBEITEN",
                   "MONTAGE DEMONTAGE", "KALIBRIERUNG KAMERA", "VERMESSEN", "GLASAUSTAUSCH")
MONITOR_MAKES = ("VOLKSWAGEN", "BMW", "MERCEDES", "FORD", "OPEL")
MONITOR_COST_CENTERS = ("bodywork", "painting", "hail", "others", "glass")
# --------------------------------------------------------------------------- end of fixed values

_SCALE = float(2 ** 53)


def uniform(key: Column, *draw: Column | int, seed: int = 42) -> Column:
    """U[0,1) from a 64-bit hash of (key, draw ids, seed)."""
    h = F.xxhash64(key, *[d if isinstance(d, Column) else F.lit(d) for d in draw], F.lit(seed))
    return F.pmod(h, F.lit(2 ** 53)).cast("double") / _SCALE


def pick(values, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def randint(lo: int, hi: int, u: Column) -> Column:
    return (F.floor(u * (hi - lo + 1)) + lo).cast("int")


def round2(c: Column) -> Column:
    return F.floor(c * 100 + 0.5) / 100


def synthetic_orders(keys: DataFrame, key: str = "order_id", seed: int = 42,
                     forced_share: float = 140 / 500, activity: float = 0.15) -> DataFrame:
    """Documents ``(order_id, input struct<make, calculatedPositions>,
    output map<string,double>)``.

    A ``forced_share`` of the orders gets one forced positive target (the
    original forces 10 orders per target out of 500)."""
    k = F.col(key)
    n_pos = randint(1, 15, uniform(k, 1, seed=seed))
    vocab = {"painting": PAINTING_WORDS, "paintmaterial": PAINTING_WORDS, "material": MATERIAL_WORDS,
             "others": MISC_WORDS}

    def position(i):
        cc = pick(SYN_COST_CENTERS, uniform(k, 2, i, seed=seed))
        n_words = randint(1, 4, uniform(k, 3, i, seed=seed))

        def word(j):
            u = uniform(k, 4, i, j, seed=seed)
            w = pick(BODYWORK_WORDS, u)
            for c, words in vocab.items():
                w = F.when(cc == c, pick(words, u)).otherwise(w)
            return w
        text = F.array_join(F.transform(F.sequence(F.lit(1), n_words), word), " ")
        price = round2(5.0 + uniform(k, 5, i, seed=seed) * 495.0)
        time_ = F.when(cc == "material", F.lit(0)).otherwise(randint(0, 30, uniform(k, 6, i, seed=seed)))
        return F.struct(text.alias("text"), cc.alias("genericCostCenter"), price.alias("totalPrice"),
                        time_.cast("double").alias("totalTime"))

    positions = F.transform(F.sequence(F.lit(1), n_pos), position)
    forced = F.when(uniform(k, 7, seed=seed) < forced_share,
                    pick(SYN_TARGETS, uniform(k, 8, seed=seed)))
    d = keys.select(k.alias("order_id"), pick(SYN_MAKES, uniform(k, 9, seed=seed)).alias("make"),
                    positions.alias("positions"), forced.alias("forced"))
    outs = []
    for ti, t in enumerate(SYN_TARGETS):
        active = (F.coalesce(F.col("forced") == t, F.lit(False))) | (uniform(k, 10, ti, seed=seed) < activity)
        lo, hi = (0.1, 1.5) if t in SHORT_TARGETS else (0.5, 8.0)
        dur = round2(lo + uniform(k, 11, ti, seed=seed) * (hi - lo))
        val = F.when(active, dur).otherwise(F.lit(0.0))
        if t == "hailrepair":
            hail = F.exists("positions", lambda p: p["text"].contains("HAGEL") | p["text"].contains("DELLEN"))
            hail_dur = round2(2.0 + uniform(k, 12, seed=seed) * 23.0)
            val = F.when(hail | ((F.col("forced") == t) & (val == 0)), hail_dur).otherwise(val)
        outs.append(val)
    out_map = F.map_from_arrays(F.array(*[F.lit(t) for t in SYN_TARGETS]), F.array(*outs))
    return d.select("order_id", F.struct("make", F.col("positions").alias("calculatedPositions")).alias("input"),
                    out_map.alias("output"))


def monitor_batch(keys: DataFrame, key: str = "order_id", seed: int = 42) -> DataFrame:
    """Monitoring requests - 1-4 positions drawn from eight phrases."""
    k = F.col(key)

    def position(i):
        return F.struct(pick(MONITOR_PHRASES, uniform(k, 21, i, seed=seed)).alias("text"),
                        round2(0.5 + uniform(k, 22, i, seed=seed) * 11.5).alias("totalTime"),
                        round2(50.0 + uniform(k, 23, i, seed=seed) * 1950.0).alias("totalPrice"),
                        pick(MONITOR_COST_CENTERS, uniform(k, 24, i, seed=seed)).alias("genericCostCenter"))
    n = randint(1, 4, uniform(k, 20, seed=seed))
    return keys.select(k.alias("order_id"), F.struct(
        pick(MONITOR_MAKES, uniform(k, 25, seed=seed)).alias("make"),
        F.transform(F.sequence(F.lit(1), n), position).alias("calculatedPositions")).alias("input"))
