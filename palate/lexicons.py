"""Aspect and valence word lists. All are plain arguments to the operators."""

from __future__ import annotations

# Eight food aspects for whole reviews.
REVIEW_ASPECTS = {
    "taste": ["taste", "tastes", "tasty", "flavor", "flavour", "flavors",
              "delicious", "yummy", "bland", "bitter", "sweet", "sour",
              "savory", "aftertaste", "spicy"],
    "quality": ["quality", "fresh", "freshness", "stale", "spoiled",
                "rotten", "mold", "moldy", "expired", "authentic",
                "genuine", "premium"],
    "freshness": ["fresh", "freshness", "stale", "old", "expired",
                  "expiry", "expiration", "date", "crisp", "soggy"],
    "packaging": ["packaging", "package", "packed", "packet", "box",
                  "sealed", "seal", "container", "wrapped", "leak",
                  "leaked", "leaking", "crushed", "damaged", "broken",
                  "bag", "bottle", "lid"],
    "price": ["price", "priced", "expensive", "cheap", "cost",
              "costly", "value", "worth", "overpriced", "affordable",
              "money", "deal", "bargain"],
    "delivery": ["delivery", "shipping", "shipped", "arrived", "arrival",
                 "melted", "late", "delayed", "fast", "quick", "prime",
                 "courier", "delivered"],
    "health": ["healthy", "health", "organic", "natural", "sugar",
               "sugarfree", "gluten", "calorie", "calories", "diet",
               "ingredient", "ingredients", "preservative",
               "preservatives", "additive", "allergy", "allergic",
               "protein", "vegan"],
    "portion": ["portion", "size", "quantity", "amount", "small",
                "large", "big", "tiny", "generous", "count", "pack"],
}

# Nine food aspects for single sentences, some terms of two words.
SENTENCE_ASPECTS = {
    "taste": ["taste", "tastes", "tasty", "flavor", "flavour", "flavored",
              "delicious", "yummy", "bland", "bitter", "sweet", "sour",
              "salty", "savory", "spicy", "aftertaste"],
    "freshness": ["fresh", "freshness", "stale", "spoiled", "rotten", "mold",
                  "moldy", "expired", "expiry", "expiration", "shelf life"],
    "texture": ["texture", "crunchy", "crispy", "crisp", "chewy", "soft",
                "hard", "soggy", "dry", "moist", "smooth", "creamy"],
    "packaging": ["package", "packaging", "packed", "packet", "box", "bag",
                  "bottle", "container", "seal", "sealed", "lid", "wrapper",
                  "leak", "leaked", "crushed", "damaged", "broken"],
    "delivery": ["delivery", "shipping", "shipped", "arrived", "arrival",
                 "delivered", "late", "delayed", "courier", "melted", "prime"],
    "price_value": ["price", "priced", "expensive", "cheap", "cost", "costly",
                    "value", "worth", "overpriced", "affordable", "money",
                    "deal", "bargain"],
    "ingredients_health": ["ingredient", "ingredients", "healthy", "health", "organic",
                           "natural", "sugar", "sugar free", "gluten", "gluten free",
                           "calorie", "calories", "diet", "protein", "vegan",
                           "allergy", "allergic", "preservative", "additive"],
    "portion_quantity": ["portion", "size", "quantity", "amount", "serving", "count",
                         "small", "large", "tiny", "generous", "ounces", "weight"],
    "quality": ["quality", "premium", "authentic", "genuine", "inferior",
                "poor quality", "high quality", "low quality"],
}

# A small seed of everyday valences on the usual -4..4 scale; pass a full list for real work.
SEED_VALENCE = {
    "amazing": 2.8, "awesome": 3.1, "awful": -2.0, "bad": -2.5, "best": 3.2, "better": 1.9,
    "bland": -1.1, "broken": -2.1, "cheap": -0.5, "crushed": -1.8, "damaged": -1.9, "delicious": 2.7,
    "disappointed": -2.1, "disappointing": -2.2, "disgusting": -2.4, "enjoy": 2.2, "excellent": 2.7,
    "fantastic": 2.6, "favorite": 2.0, "fine": 0.8, "fresh": 1.3, "good": 1.9, "great": 3.1,
    "happy": 2.7, "hate": -2.7, "horrible": -2.5, "inedible": -2.0, "late": -0.9, "like": 1.5,
    "love": 3.2, "loved": 2.9, "moldy": -2.2, "nice": 1.8, "perfect": 2.7, "poor": -2.1,
    "recommend": 1.5, "rich": 1.1, "rotten": -2.3, "sad": -2.1, "stale": -1.6, "tasty": 1.9,
    "terrible": -2.1, "thank": 1.5, "wonderful": 2.7, "worse": -2.1, "worst": -3.1, "yummy": 2.4,
}

SEED_NEGATORS = [
    "not", "no", "never", "none", "nothing", "neither", "nor", "without", "cannot",
    "can't", "don't", "doesn't", "didn't", "isn't", "wasn't", "aren't", "weren't",
    "won't", "wouldn't", "couldn't", "shouldn't", "hardly", "rarely",
]

# What a booster adds to a valence's size, or takes from it; a small seed of each.
BOOST = 0.293
SEED_BOOSTERS = {
    **dict.fromkeys(["absolutely", "amazingly", "completely", "deeply", "especially", "exceptionally", "extremely", "highly", "incredibly",
                     "more", "most", "particularly", "really", "remarkably", "so", "totally", "truly", "unbelievably", "utterly", "very"], BOOST),
    **dict.fromkeys(["almost", "barely", "less", "little", "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat"], -BOOST),
}
