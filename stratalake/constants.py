"""Names, formats and word lists that inputs and outputs must agree on."""

# Raw file names.
SALES_GLOB = "ventas_*.{csv,xlsx}"
SALES_FILE = r"/(ventas_[^/]*\.(?:csv|xlsx)(?:/[^/]*)?)$"
WEATHER_GLOB = "weather_*.json"
WEATHER_FILE = r"/(weather_[^/]*\.json(?:/[^/]*)?)$"
WEATHER_STAMP = "%Y%m%dT%H%M%SZ"

# Columns of a sales file.
REQUIRED_SALES_COLUMNS = ("order_id", "product", "quantity", "price")
SALES_KEY = ("order_id", "product")

# Cell texts that mean "no value" (the documented defaults of pandas readers).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Products of the synthetic sales rows.
SYNTHETIC_PRODUCTS = ("Zapatos", "Camiseta", "Pantalon", "Gorra")

# Arrays of a weather document, and its Spark schema.
WEATHER_ARRAYS = ("time", "temperature_2m", "relative_humidity_2m")
WEATHER_DOCUMENT = (
    "latitude DOUBLE, longitude DOUBLE, "
    "hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, "
    "relative_humidity_2m: ARRAY<DOUBLE>>"
)
