"""Names that a run's settings, drops and report share with its users."""

# Keys of the settings files.
PRIMARY_KEYS = "primary.keys"
REFERENCE_DATABASE = "hive.database"
REFERENCE_TABLE = "hive.table"
DELIVERED_DELIMITER = "csv.delimiter"
OUTPUT_PATH = "output.path"
DROP_FOLDER = "source.file.path"
ARCHIVE_FOLDER = "archive.directory"

# Name of the view over the delivered table, drop prefix, lines of a settings
# sheet that a legacy run reads, and parts of names.
DELIVERED_VIEW = "csv_temp_table"
DROP_PREFIX = "dq_check_"
SETTINGS_ROWS = 110
RUN_NAME_PART = "_CompareData_"
TABLE_NAME_END = "_CSV"

# Titles of the report sheets, and the labels in them.
SHEET_COLUMN_COUNTS = "Column Counts"
SHEET_COLUMNS = "CSV Columns"
SHEET_KEYS_PRESENT = "Primary Keys Data Present"
SHEET_KEYS_ABSENT = "Primary Keys Not Present"
SHEET_PERCENT = "Percentage"
LABEL_REFERENCE = "Hive Table"
LABEL_DELIVERED = "CSV Table"
LABEL_MATCHING = "Matching Data"
LABEL_NOT_MATCHING = "Non Matching Data"
