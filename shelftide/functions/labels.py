"""Labels shared by the layers, the checks and the report tables."""

NOT_APPLICABLE = "n/a"
UNKNOWN = "unknown"

BEFORE, AFTER = "before", "after"
MAIN, DISPUTED = "main", "disputed"
SALES, DEMAND = "sales", "demand"

SMOOTH, ERRATIC = "smooth", "erratic"
INTERMITTENT, LUMPY = "intermittent", "lumpy"
QUADRANTS = (SMOOTH, ERRATIC, INTERMITTENT, LUMPY, NOT_APPLICABLE)

TOTAL = "total"
ORDINARY_STORE, OUTLIER_STORE = "ordinary", "outlier"

ERROR, WARNING, OK = "error", "warning", "ok"

# Attributes that belong to the pair, not to the day.
PAIR_ATTRIBUTES = ("LocationId", "ItemId", "ItemIdLevel2", "ItemIdLevel3",
                   "LocationNetwork", "LocationFormatTT")

ABC_COLUMNS = ("AbcRevenueStore", "AbcRevenueSubgroup", "AbcQtyStore", "AbcQtySubgroup",
               "AbcFreqStore", "AbcFreqSubgroup")
