"""Domain configuration as data.

Every operator in the package takes an :class:`OrderConfig`; nothing is
hard-wired to one vocabulary.  Two configurations ship:

* :func:`body_shop` - the German body-shop vocabulary the original tool was
  built for (fixed values, see the block below).
* :func:`part_catalog` - the same roles mapped onto the driver's TPC-H-style
  tables (``p_type`` plays the cost centre and the target, the part names are
  the free text).  Used by the registered queries and the tests.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class OrderConfig:
    targets: tuple[str, ...]
    cost_centers: tuple[str, ...]
    top_makes: tuple[str, ...]
    # name -> regex, searched in the lower-cased full order text
    keyword_flags: dict[str, str]
    # target -> keyword flag names used for explanations (H3)
    target_keywords: dict[str, tuple[str, ...]]
    # target -> regex of the rule baseline
    rule_patterns: dict[str, str]
    # cost centre -> targets it feeds
    cc_to_targets: dict[str, tuple[str, ...]]
    # cost centres whose time share / price share become ratio features (C4)
    ratio_time_ccs: tuple[str, ...]
    ratio_price_ccs: tuple[str, ...]
    # cost centres with a has_<cc>_cc flag
    flag_ccs: tuple[str, ...]
    # cost centre and targets of the paint-time regression
    paint_cc: str = ""
    paint_targets: tuple[str, ...] = ()
    # targets shown in the make box plot
    box_targets: tuple[str, ...] = ()
    conversion_factors: tuple[float, ...] = (6.0, 10.0, 12.0, 60.0, 1.0)
    target_labels: dict[str, str] = field(default_factory=dict)
    # target -> stage-2 learner (G5): lgbm, ridge or ridge_auto; lgbm where a target isn't listed
    best_regressor: dict[str, str] = field(default_factory=dict)
    unknown_cc: str = "unknown_cc"
    empty_placeholder: str = "[leer]"


# ---------------------------------------------------------------------------
# FIXED VALUES - must equal the original tool's configuration for identical
# results on its data: 14 targets in display order, their labels, the six
# generic cost centres, the eight one-hot makes, the 17 keyword regexes, the
# target -> keyword map, the 14 rule-baseline regexes, the cost-centre ->
# target map of the unit-ratio study and the conversion-factor grid.
# ---------------------------------------------------------------------------
BODY_SHOP_TARGETS = (
    "calibration", "wheelmeasurement", "bodymeasurement",
    "dismounting", "bodyrepair", "assembly", "plasticrepair",
    "allTiresService", "cleaning", "paintingPreparation",
    "paintingSpraying", "paintingFinish", "hailrepair", "glas",
)
BODY_SHOP_LABELS = {
    "calibration": "Calibration (ADAS/cameras)",
    "wheelmeasurement": "Wheel alignment measurement",
    "bodymeasurement": "Body/chassis measurement",
    "dismounting": "Dis-/mounting",
    "bodyrepair": "Body repair",
    "assembly": "Assembly",
    "plasticrepair": "Plastic repair",
    "allTiresService": "Tyre service",
    "cleaning": "Cleaning",
    "paintingPreparation": "Painting — preparation",
    "paintingSpraying": "Painting — spraying",
    "paintingFinish": "Painting — finish",
    "hailrepair": "Hail repair",
    "glas": "Glass replacement",
}
BODY_SHOP_COST_CENTERS = ("bodywork", "painting", "paintmaterial", "material", "others", "hail")
BODY_SHOP_TOP_MAKES = ("VOLKSWAGEN", "MERCEDES-BENZ", "BMW", "FORD", "SKODA", "AUDI", "OPEL", "TESLA")
BODY_SHOP_KEYWORDS = {
    "kw_vermessung": r"vermess|kinematik|spur|sturz",
    "kw_kalibrier": r"kalibrier|adas|fas|kamera.*kalib|radar.*ausrich",
    "kw_glas": r"glas|scheibe|frontscheibe|windschutz|heckscheibe|windlauf",
    "kw_hagel": r"hagel|dellen|pdr|smart.*repar",
    "kw_reifen": r"reifen|felge|rad(?:wechsel|montage|service)",
    "kw_reinigung": r"reinigung|waesch|polier",
    "kw_lack": r"lackier|lack(?!material)|oberflaech.*lack|neu.*lack",
    "kw_vorbereitung": r"vorbereitung|grundier|fuellerauftrag|vorbereit",
    "kw_klebetechnik": r"klebe|klebetechnik",
    "kw_montage": r"a\+e|montage|einbau|ausbau|demontage|ersatz",
    "kw_hybrid": r"hybrid|elektro|hochspannung|hv.system",
    "kw_plastik": r"plastik|kunststoff|stossfaenger.*repar",
    "kw_karosserie": r"karosserie|blech|beul|richt",
    "kw_scheibe_ers": r"scheibe.*ers|frontscheibe|windschutz.*ers",
    "kw_dellen": r"dellen|dent|beule",
    "kw_sensor": r"sensor|pdc|adas|ultraschall",
    "kw_material": r"kleinmaterial|ersatzteil|lackmaterial",
}
BODY_SHOP_TARGET_KEYWORDS = {
    "calibration": ("kw_kalibrier", "kw_sensor"),
    "wheelmeasurement": ("kw_vermessung",),
    "bodymeasurement": ("kw_vermessung", "kw_karosserie"),
    "dismounting": ("kw_montage",),
    "bodyrepair": ("kw_karosserie",),
    "assembly": ("kw_montage",),
    "plasticrepair": ("kw_plastik",),
    "allTiresService": ("kw_reifen",),
    "cleaning": ("kw_reinigung",),
    "paintingPreparation": ("kw_vorbereitung", "kw_lack"),
    "paintingSpraying": ("kw_lack",),
    "paintingFinish": ("kw_lack", "kw_klebetechnik"),
    "hailrepair": ("kw_hagel", "kw_dellen"),
    "glas": ("kw_glas", "kw_scheibe_ers"),
}
BODY_SHOP_RULES = {
    "calibration": r"kalibrier|adas|fas|kamera|radar|sensor.*ausrich",
    "wheelmeasurement": r"fahrwerksvermess|kinematik|spur|sturzwinkel|radvermess",
    "bodymeasurement": r"karosserievermess|3d.*vermess|richtrahmen|vermess.*kaross",
    "dismounting": r"\ba\+e\b|de-?/montage|ausgebaut|ausbauen|einbauen|demontage",
    "bodyrepair": r"blech|beul|dent|richt|karosserie.*repar|schweiss",
    "assembly": r"montage(?!.*de)|zusammenbau|verbindung.*teil|einbau(?!en)",
    "plasticrepair": r"plastik|kunststoff|stoßfänger.*repar|bumper.*repar",
    "allTiresService": r"reifen|rad(?:wechsel|service|montage)|felge",
    "cleaning": r"reinigung|wäsche|polier|entstörung",
    "paintingPreparation": r"vorbereitung.*lack|grundier|füller|vorbereit.*lack",
    "paintingSpraying": r"lackier|neu.*lackier|spritz",
    "paintingFinish": r"finish|polier|lack.*fertig|abschlusspolit",
    "hailrepair": r"hagel|dellen(?!.*repar)|pdr|smart.*repar",
    "glas": r"glas|scheibe|frontscheibe|windschutz|heckscheibe",
}
BODY_SHOP_CC_TO_TARGETS = {
    "bodywork": ("dismounting", "assembly", "bodyrepair", "bodymeasurement",
                 "wheelmeasurement", "calibration", "cleaning"),
    "painting": ("paintingPreparation", "paintingSpraying", "paintingFinish"),
    "paintmaterial": (),
    "material": (),
    "others": (),
}
BODY_SHOP_BOX_TARGETS = ("bodymeasurement", "assembly", "paintingPreparation",
                         "paintingSpraying", "glas", "calibration", "cleaning", "dismounting")
BODY_SHOP_BEST_REGRESSOR = {
    "calibration": "lgbm",
    "wheelmeasurement": "lgbm",
    "bodymeasurement": "lgbm",
    "dismounting": "lgbm",
    "bodyrepair": "ridge",
    "assembly": "ridge",
    "plasticrepair": "lgbm",
    "cleaning": "lgbm",
    "paintingPreparation": "ridge",
    "paintingSpraying": "lgbm",
    "paintingFinish": "ridge",
    "hailrepair": "ridge_auto",
    "glas": "lgbm",
    "allTiresService": "lgbm",
}
CONVERSION_FACTORS = (6.0, 10.0, 12.0, 60.0, 1.0)
# --------------------------------------------------------------------------- end of fixed values


def body_shop() -> OrderConfig:
    return OrderConfig(
        targets=BODY_SHOP_TARGETS,
        cost_centers=BODY_SHOP_COST_CENTERS,
        top_makes=BODY_SHOP_TOP_MAKES,
        keyword_flags=dict(BODY_SHOP_KEYWORDS),
        target_keywords=dict(BODY_SHOP_TARGET_KEYWORDS),
        rule_patterns=dict(BODY_SHOP_RULES),
        cc_to_targets=dict(BODY_SHOP_CC_TO_TARGETS),
        ratio_time_ccs=("painting", "bodywork", "hail"),
        ratio_price_ccs=("material",),
        flag_ccs=("hail", "painting", "bodywork"),
        paint_cc="painting",
        paint_targets=("paintingPreparation", "paintingSpraying", "paintingFinish"),
        box_targets=BODY_SHOP_BOX_TARGETS,
        conversion_factors=CONVERSION_FACTORS,
        target_labels=dict(BODY_SHOP_LABELS),
        best_regressor=dict(BODY_SHOP_BEST_REGRESSOR),
    )


# Our own mapping onto the driver tables: p_type values are the cost centres
# and the targets; part names / types / brands are the position texts.
PART_TYPES = ("economy", "large", "medium", "promo", "small", "standard")


def part_catalog() -> OrderConfig:
    return OrderConfig(
        targets=PART_TYPES,
        cost_centers=PART_TYPES,
        top_makes=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
        keyword_flags={
            "kw_warm": r"red|hot",
            "kw_cool": r"blue|cold",
            "kw_hot_plate": r"hot.*plate",
            "kw_small_part": r"small(?! widget)",
            "kw_fastener": r"rod|bolt",
            "kw_new_gear": r"new.*gear",
            "kw_brand_teens": r"brand#1\d\b",
            "kw_anvil": r"anvil",
            "kw_promo_large": r"promo.*large|large.*promo",
        },
        target_keywords={
            "economy": ("kw_cool",),
            "large": ("kw_promo_large",),
            "medium": ("kw_fastener",),
            "promo": ("kw_promo_large", "kw_warm"),
            "small": ("kw_small_part",),
            "standard": ("kw_anvil", "kw_new_gear"),
        },
        rule_patterns={
            "economy": r"economy|brand#1\b",
            "large": r"large",
            "medium": r"medium|gear",
            "promo": r"promo",
            "small": r"small(?! widget)",
            "standard": r"standard|plate",
        },
        cc_to_targets={
            "economy": ("economy",),
            "large": ("large", "promo"),
            "medium": ("medium",),
            "promo": ("promo",),
            "small": ("small",),
            "standard": ("standard",),
        },
        ratio_time_ccs=("standard", "large", "small"),
        ratio_price_ccs=("economy",),
        flag_ccs=("small", "standard", "large"),
        paint_cc="promo",
        paint_targets=("promo", "large", "small"),
        box_targets=PART_TYPES,
        conversion_factors=CONVERSION_FACTORS,
        target_labels={t: t.capitalize() for t in PART_TYPES},
        best_regressor={"economy": "lgbm", "large": "ridge", "medium": "ridge", "promo": "lgbm", "small": "lgbm", "standard": "ridge_auto"},
    )
