"""Names that jobs and their readers share."""

# Columns that place a row.
NEIGHBORHOOD = "neighborhood_id"
PLACE_NAMES = ["neighborhood_n_reconciled", "district_id", "district_n_reconciled"]

# Keys of the listings and of the open-data tables, and of their lookups.
LISTING_KEYS = ["district", "neighborhood"]
OPEN_DATA_KEYS = {"Nom_Districte": "district", "Nom_Barri": "neighborhood"}

# Nested columns of the listings that become JSON text.
LISTING_JSON = ["detailedType", "suggestedTexts"]

# Commerce categories.
CATEGORIES = ["Codi_Grup_Activitat", "Nom_Grup_Activitat"]

# Names of the sources in the registry and of their lookups.
LISTINGS_SOURCE = "idealista"
INCOME_SOURCE = "opendatabcn-income"
COMMERCIAL_SOURCE = "opendatabcn-commercial"
LISTINGS_LOOKUP = "lookup_tables_idealista"
OPEN_DATA_LOOKUP = "lookup_tables_opendatabcn"

# Names of the formatted and of the result tables.
LISTINGS_TABLE = "idealista"
INCOME_TABLE = "opendatabcn_income"
COMMERCIAL_TABLE = "opendatabcn_commercial"
COUNT_TABLE = "idealista_count_neighbors"
AVERAGES_TABLE = "correlation_average_price_index_neigh"
PRICES_TABLE = "correlation_price_index_neigh"
CATEGORIES_TABLE = "count_commerce_categories"
MESSAGES_TABLE = "kafka_data"
