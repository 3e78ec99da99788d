"""Fixed values.

Everything in this module is a value that must equal the behaviour being
reproduced (word lists, dictionaries, patterns, thresholds, label texts).
They are stated plainly, in their natural order, and used as parameters by
the Column builders in ``text.py`` and ``scoring.py``.
"""

from __future__ import annotations

# --- FIXED VALUES: ingredient tokeniser ---------------------------------------
# A comma splits unless the next parenthesis after it is a closing one.
# (?U) makes \s Unicode-aware like Python's re; possessive quantifiers keep the
# look-ahead linear per comma.
INGREDIENT_SPLIT_PATTERN = r"(?U),\s*+(?![^()]*+\))"
# Equivalent split for texts without any ')': the look-ahead can never fail.
PLAIN_SPLIT_PATTERN = r"(?U),\s*+"

# Unicode-aware trim (Python str.strip semantics).
UNICODE_TRIM_PATTERN = r"(?U)^\s+|\s+$"

# Synonym map of the full parser (F2/F3), in the order it is written.
DEFAULT_SYNONYMS: dict[str, str] = {
    "flavourings": "flavouring",
    "natural flavourings": "natural flavouring",
    "spices": "spice",
    "vegetable oils": "vegetable oil",
    "sugar syrup": "sugar",
    "glucose syrup": "sugar",
    "glucose-fructose syrup": "sugar",
    "fructose": "sugar",
}

# Prefixes that mark an allergen statement rather than an ingredient (F2).
DEFAULT_SKIP_PREFIXES: tuple[str, ...] = (
    "including ",
    "contains ",
    "contains:",
    "may contain ",
    "allergen",
)

# Older parser variant (F4): six synonyms and two prefixes.
BASIC_SYNONYMS: dict[str, str] = {
    "flavourings": "flavouring",
    "natural flavourings": "natural flavouring",
    "spices": "spice",
    "vegetable oils": "vegetable oil",
    "sugar syrup": "sugar",
    "glucose syrup": "sugar",
}
BASIC_SKIP_PREFIXES: tuple[str, ...] = ("including ", "contains ")

# --- FIXED VALUES: additives and scoring ------------------------------------
# E-number pattern, case-insensitive, Unicode word boundaries.
E_NUMBER_PATTERN = r"(?iU)\bE\d{3,4}[a-z]?\b"
# RE2 (DuckDB) form of the same pattern for the oracle queries.
E_NUMBER_PATTERN_RE2 = r"(?i)\bE\d{3,4}[a-z]?\b"

# Concerning additives: (lower-case substring, description), dictionary order.
CONCERNING_ADDITIVES: tuple[tuple[str, str], ...] = (
    ("aspartame", "Artificial sweetener (E951)"),
    ("acesulfame", "Artificial sweetener (E950)"),
    ("sucralose", "Artificial sweetener (E955)"),
    ("saccharin", "Artificial sweetener (E954)"),
    ("sodium benzoate", "Preservative (E211)"),
    ("potassium sorbate", "Preservative (E202)"),
    ("sodium nitrite", "Preservative linked to health concerns (E250)"),
    ("sodium nitrate", "Preservative (E251)"),
    ("tartrazine", "Artificial colour (E102)"),
    ("sunset yellow", "Artificial colour (E110)"),
    ("carmoisine", "Artificial colour (E122)"),
    ("brilliant blue", "Artificial colour (E133)"),
    ("caramel colour", "Colour additive (E150)"),
    ("monosodium glutamate", "Flavour enhancer (E621)"),
    ("disodium guanylate", "Flavour enhancer (E627)"),
    ("disodium inosinate", "Flavour enhancer (E631)"),
    ("carrageenan", "Thickener with disputed safety (E407)"),
    ("xanthan gum", "Thickener (E415)"),
    ("polysorbate", "Emulsifier (E432-E436)"),
    ("phosphoric acid", "Acidifier, may affect calcium absorption (E338)"),
    ("citric acid", "Acidifier (E330)"),
    ("modified starch", "Processed starch"),
    ("maltodextrin", "Highly processed carbohydrate"),
    ("hydrogenated", "Trans fats indicator"),
    ("palm oil", "Environmental/health concerns"),
)

# Processing score (F10) constants.
NOVA_STEP_POINTS = 13          # (nova - 1) * 13
NOVA_UNKNOWN_POINTS = 20
E_NUMBER_POINTS = 5
E_NUMBER_CAP = 30
ADDITIVE_POINTS = 6
ADDITIVE_CAP = 30
SCORE_CAP = 100

# NOVA labels.
NOVA_LABELS: dict[int, str] = {
    1: "Unprocessed/Minimal",
    2: "Processed Culinary",
    3: "Processed",
    4: "Ultra-Processed",
}
NOVA_UNKNOWN_LABEL = "Unknown"

# Processing badges (F12): (upper bound inclusive, emoji, label).
PROCESSING_BADGES: tuple[tuple[int | None, str, str], ...] = (
    (20, "🟢", "Minimally Processed"),
    (40, "🟡", "Lightly Processed"),
    (60, "🟠", "Moderately Processed"),
    (None, "🔴", "Highly Processed"),
)
ULTRA_PROCESSED_THRESHOLD = 60

# Product analysis suggestions.
SUGGESTION_E_NUMBERS = "Contains {n} E-numbers - look for products with fewer additives"
SUGGESTION_SWEETENER = "Contains artificial sweeteners - try naturally sweetened alternatives"
SUGGESTION_COLOUR = "Contains artificial colours - look for naturally coloured options"
SUGGESTION_PALM_OIL = "Contains palm oil - consider products with other vegetable oils"
WHY_UPF_DEFAULT = "Contains multiple E-numbers or additives."

# Healthiness score (F15) weights and caps.
HEALTH_INGREDIENT_CAP = 20
HEALTH_E_NUMBER_CAP = 10
HEALTH_ADDITIVE_CAP = 5
HEALTH_DEFAULT_INGREDIENTS = 20
HEALTH_DEFAULT_NOVA = 4
EXPLANATION_DEFAULT = "Similar processing, different brand"

# --- FIXED VALUES: catalogue cleaning ----------------------------------------
# Foreign-language keywords (kept verbatim, including the misspelling).
FOREIGN_KEYWORDS: tuple[str, ...] = ("zucker", "wasser", "spiesesalz", "weizenmehl")
# Soup concentrate words.
CONCENTRATE_WORDS: tuple[str, ...] = ("stock", "pot", "cube", "bouillon", "powder", "instant", "dry", "mix")
CONCENTRATE_CATEGORY = "Soup"
# Country filter patterns (P1) and exact-membership tokens.
IRELAND_ILIKE: tuple[str, ...] = ("%Ireland%", "%en:ie%")
IRELAND_TOKENS: tuple[str, ...] = ("ireland", "ie")
# Biscuit subset.

# Dashboard KPI thresholds (A2).
HIGH_SUGAR_THRESHOLD = 10.0
HIGH_SALT_THRESHOLD = 1.5

# --- FIXED VALUES: search categories of the harvest ---------------------------
SEARCH_CATEGORIES: tuple[str, ...] = (
    "Biscuits", "Bread", "Yogurt", "Cereal", "Crisps",
    "Sausages", "Jam", "Soup", "Pizza", "Cheese",
    "Soft Drinks", "Frozen Meals",
)

# --- FIXED VALUES: ranking evaluation -----------------------------------------
RELEVANCE_SAME_CATEGORY = 3
RELEVANCE_SIMILAR_NOVA = 2
SAME_CATEGORY_LIMIT = 10
SIMILAR_NOVA_LIMIT = 15
DISSIMILAR_THRESHOLD = 0.7

# --- FIXED VALUES: data-quality gates ------------------------------------------
QUALITY_GATES: tuple[tuple[str, float], ...] = (
    ("ingredients_complete_pct", 70.0),
    ("nutrients_complete_pct", 50.0),
    ("nova_complete_pct", 60.0),
)
VOLUME_TOTAL_RANGE = (2000, 2500)
VOLUME_CATEGORY_RANGE = (50, 300)
MISSING_NUTRIENT_WARN_PCT = 50.0
MISSING_INGREDIENT_WARN_PCT = 30.0
SMALL_CATEGORY_MIN = 50
