"""Values every zone agrees on.

Fixed values: results are only right when these stay exactly as they are.
"""

# Text lengths of the refined customer columns.
NAME_LENGTH = 100
EMAIL_LENGTH = 100
LOCATION_LENGTH = 45
COUNTRY_LENGTH = 45
STATE_LENGTH = 45
CITY_LENGTH = 80
POSTAL_CODE_LENGTH = 45

# Column orders.
REFINED_INPUT_COLUMNS = ("customer_key", "customer_id", "created", "updated", "content", "updated_on")
EXPORT_COLUMNS = ("Customer_Key", "customer_id", "created", "updated", "Content", "Updated_On")

# Order extract columns that hold a timestamp.
ORDER_TIMESTAMP_COLUMNS = (
    "order_date",
    "order_date_plant_timezone",
    "slot_closed_date",
    "slot_closed_date_plant_timezone",
    "timestamp_sales_order",
    "timestamp_production_order",
    "arrival_date",
)

# Timestamp formats, and the shape of texts in the first one.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
WATERMARK_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DAY_FORMAT = "yyyy-MM-dd"

# Bounds and sizes.
EPOCH_FLOOR = "1970-01-01 00:00:00"
INITIAL_WATERMARK = "1970-01-01T00:00:00Z"
WINDOW_STEP_DAYS = 2
BACKFILL_START = "2022-01-01"
BACKFILL_END = "2025-01-19"
MINIMUM_ROWS = 100
PREVIEW_ROWS = 5
TARGET_FILE_BYTES = 268435456
EXPORT_GZIP_LEVEL = 5
PARTITION_COLUMN = "DT_PARTITION"

# Text that a CSV extract uses for "no value" (the defaults of pandas.read_csv).
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
