"""Values that decide results and therefore must stay exactly as they are."""

# --- fixed values: text rules -------------------------------------------------

# Markup and entity remains, each match becoming one space.  (?d): "." stops at \n only.
MARKUP = r"(?d)<.*?>|&lt;.*?&gt;|&?(amp|nbsp|quot);|\{\}"

# Characters that count as white space for blank tests and stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Words that mean "no value" in a delimited table.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

LABEL_PREFIX = "__label__"

# Endings of files in an extracted archive that hold no sentences.
UNWANTED_ENDINGS = (".ids", ".scores", ".xml", "LICENSE", "README")

# --- fixed values: thresholds -------------------------------------------------

MIN_LENGTH = 3
MAX_LENGTH = 200
MAX_LENGTH_RATIO = 2.0
SEMANTIC_THRESHOLD = 0.7
QUALITY_THRESHOLD = 0.7

# --- fixed values: encoder families, in order of priority ---------------------

ENCODER_FAMILIES = {
    "distiluse-base-multilingual-cased-v1": ("ar", "de", "en", "es", "fr", "it", "ko", "nl", "pt", "ru", "tr", "zh"),
    "paraphrase-multilingual-MiniLM-L12-v2": (
        "ar", "bg", "ca", "cs", "da", "de", "en", "el", "es", "et", "fa", "fi", "fr", "gl", "gu",
        "he", "hi", "hr", "hu", "hy", "id", "it", "ja", "ka", "ko", "ku", "lt", "lv", "mk", "mn",
        "mr", "ms", "my", "nb", "nl", "pl", "pt", "ro", "ru", "sk", "sl", "sq", "sr", "sv", "th",
        "tr", "uk", "ur", "vi", "zh",
    ),
    "microsoft/Multilingual-MiniLM-L12-H384": ("en", "ar", "bg", "de", "el", "es", "fr", "hi", "ru", "sw", "th", "tr", "ur", "vi", "zh"),
    "sentence-transformers/LaBSE": (
        "af", "sq", "am", "ar", "hy", "as", "az", "eu", "be", "bn", "bs", "bg", "my", "ca", "ceb",
        "zh", "co", "hr", "cs", "da", "nl", "en", "eo", "et", "fi", "fr", "fy", "gl", "ka", "de",
        "el", "gu", "ht", "ha", "haw", "he", "hi", "hmn", "hu", "is", "ig", "id", "ga", "it", "ja",
        "jv", "kn", "kk", "km", "rw", "ko", "ku", "ky", "lo", "la", "lv", "lt", "lb", "mk", "mg",
        "ms", "ml", "mt", "mi", "mr", "mn", "ne", "no", "ny", "or", "fa", "pl", "pt", "pa", "ro",
        "ru", "sm", "gd", "sr", "st", "sn", "si", "sk", "sl", "so", "es", "su", "sw", "sv", "tl",
        "tg", "ta", "tt", "te", "th", "bo", "tr", "tk", "ug", "uk", "ur", "uz", "vi", "cy", "wo",
        "xh", "yi", "yo", "zu",
    ),
}

# --- fixed values: report and metadata columns --------------------------------

SUMMARY_HEADER = (
    "Source", "Dataset", "Original", "After Rule", "After Semantic",
    "After Lang Detect", "After QE", "Translation Quality",
)
