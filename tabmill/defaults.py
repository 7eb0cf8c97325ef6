"""Fixed values of the house-price data set; every operator takes them as parameters."""

from __future__ import annotations

# --- fixed values: tokens that mean "missing" in the raw files ---
MISSING_TOKENS = ["NA", "N/A", "null", "None", ""]

# --- fixed values: further tokens a CSV reader takes as missing by default ---
READER_MISSING_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "NULL", "NaN", "n/a", "nan",
]

# --- fixed values: keys and label ---
ID_COLUMN = "Id"
LABEL_COLUMN = "SalePrice"

# --- fixed values: columns where missing means "not present" ---
NONE_FILL = [
    "PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu", "GarageQual", "GarageFinish",
    "GarageType", "GarageCond", "BsmtExposure", "BsmtCond", "BsmtQual", "BsmtFinType2", "BsmtFinType1",
]
ZERO_FILL = ["GarageYrBlt"]

# --- fixed values: columns the exploration fills with global statistics ---
MEDIAN_FILL = ["LotFrontage", "MasVnrArea"]
MODE_FILL = ["MasVnrType", "Electrical"]

# --- fixed values: components and weights of the summed features ---
FLOOR_AREA = {"TotalBsmtSF": 1.0, "1stFlrSF": 1.0, "2ndFlrSF": 1.0}
BATHS = {"FullBath": 1.0, "HalfBath": 0.5, "BsmtFullBath": 1.0, "BsmtHalfBath": 0.5}
PORCHES = {
    "OpenPorchSF": 1.0, "EnclosedPorch": 1.0, "3SsnPorch": 1.0, "ScreenPorch": 1.0, "WoodDeckSF": 1.0,
}

# --- fixed values: presence flags and the column each one looks at ---
PRESENCE_FLAGS = {
    "HasBasement": "TotalBsmtSF",
    "HasGarage": "GarageArea",
    "HasFireplace": "Fireplaces",
    "HasPool": "PoolArea",
}

# --- fixed values: ordinal scales, best level first; the last level is 0 ---
QUALITY_SCALE = ["Ex", "Gd", "TA", "Fa", "Po", "None"]
EXPOSURE_SCALE = ["Gd", "Av", "Mn", "No", "None"]
BASEMENT_FINISH_SCALE = ["GLQ", "ALQ", "BLQ", "Rec", "LwQ", "Unf", "None"]
FUNCTIONAL_SCALE = ["Typ", "Min1", "Min2", "Mod", "Maj1", "Maj2", "Sev", "Sal"]
GARAGE_FINISH_SCALE = ["Fin", "RFn", "Unf", "None"]
PAVED_SCALE = ["Y", "P", "N"]

ORDINAL_COLUMNS = {
    "ExterQual": QUALITY_SCALE,
    "ExterCond": QUALITY_SCALE,
    "BsmtQual": QUALITY_SCALE,
    "BsmtCond": QUALITY_SCALE,
    "HeatingQC": QUALITY_SCALE,
    "KitchenQual": QUALITY_SCALE,
    "FireplaceQu": QUALITY_SCALE,
    "GarageQual": QUALITY_SCALE,
    "GarageCond": QUALITY_SCALE,
    "PoolQC": QUALITY_SCALE,
    "BsmtExposure": EXPOSURE_SCALE,
    "BsmtFinType1": BASEMENT_FINISH_SCALE,
    "BsmtFinType2": BASEMENT_FINISH_SCALE,
    "Functional": FUNCTIONAL_SCALE,
    "GarageFinish": GARAGE_FINISH_SCALE,
    "PavedDrive": PAVED_SCALE,
}

# --- fixed values: upper cuts (exclusive) and labels of the price buckets ---
PRICE_CUTS = [
    (100000, "0-100k"),
    (150000, "100k-150k"),
    (200000, "150k-200k"),
    (300000, "200k-300k"),
    (400000, "300k-400k"),
    (500000, "400k-500k"),
]
PRICE_REST = "500k+"

# --- fixed values: marker of a missing category ---
MISSING_CATEGORY = "__missing__"

# --- fixed values: pattern of a run version, e.g. 20240131_235959 ---
RUN_VERSION_FORMAT = "yyyyMMdd_HHmmss"
