"""Fixed values.

Every value here must equal the reference's behaviour for results to
match; they are stated plainly, in their natural order, and imported from
here everywhere else.
"""

# --- FIXED VALUES (must equal the reference) -----------------------------------------

# Text the lake reader turns into a missing value: the default missing-value
# tokens of the pandas CSV reader, which the reference's loaders rely on.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Display placeholder for a missing value (an en dash).
PLACEHOLDER = "–"

# Separator of the genre list kept in one string ("Action, Drama").
GENRE_SEPARATOR = ","

# Lake generator: target genres in priority order, search terms in order,
# titles accepted per genre, pages read per term.
TARGET_GENRES = ["Action", "Sci-Fi", "Comedy"]
SEARCH_TERMS = ["Life", "World", "Star", "Man"]
QUOTA_PER_GENRE = 15
SEARCH_PAGES = 5

# Lake generator: synthetic users and ratings.
USER_COUNT = 20
RATINGS_PER_USER = 5
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55+"]
COUNTRIES = [
    "Brazil", "United States", "Mexico", "Argentina", "Colombia",
    "Portugal", "Germany", "France", "United Kingdom", "Spain",
]
SCORE_MIN = 1.0
SCORE_MAX = 10.0
SCORE_DECIMALS = 1
RATED_AT = "2024-02-15"
SEED = 42

# Declared column limits of the warehouse tables.
MAX_LENGTH = {
    "movie_id": 20,
    "imdb_id": 20,
    "title": 255,
    "genre": 255,
    "country": 255,
    "name": 255,
    "age_group": 20,
}

# Rows per genre in the top-titles mart; rows of the top-k reports.
TOP_PER_GENRE = 10
TOP_POPULAR = 5
TOP_GENRES = 10
TOP_GENRES_SHORT = 5
TOP_COUNTRIES = 10
TOP_COUNTRIES_SHORT = 5
