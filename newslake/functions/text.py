"""Text cleaning, tokenizers and token filters as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# -- fixed values: they decide which words are counted -----------------------
STOPWORDS_FR = (
    "avec", "avoir", "cette", "comme", "dans", "des", "donc", "elle", "elles", "est",
    "et", "être", "fois", "faire", "mais", "même", "nous", "par", "pas", "plus", "pour",
    "que", "qui", "sur", "tout", "une", "vos", "vous",
)
STOPWORDS_EN = (
    "the", "and", "for", "with", "that", "this", "from", "are", "was", "were", "have",
    "has", "had", "not", "but", "you", "your", "their", "they", "his", "her", "its",
    "into", "over", "more",
)
STOPWORDS_AR = (
    "من", "في", "على", "إلى", "عن", "أن", "إن", "كان", "كما", "هذا", "هذه", "هناك",
)
# -----------------------------------------------------------------------------

STOPWORDS = {"fr": STOPWORDS_FR, "en": STOPWORDS_EN, "ar": STOPWORDS_AR}

# Unicode white space and the four ASCII separators. The property is faster to
# test than a set that spells its members out.
_SPACE = r"[\s\x1c-\x1f]"
_TAG = "<[^>]+>"

# Dotless i and long s are in the class because they fold to i and s.
_BATCH_SEPARATORS = r"[^0-9a-zıſ؀-ۿ]+"
_SPEED_WORD = r"([\p{L}\p{N}_؀-ۿ']+)"
_ALL_DIGITS = r"^[0-9٠-٩۰-۹]+$"
# Decimal digits of any script, and the superscript, subscript, circled,
# parenthesised and full-stop digits that Unicode also types as digits.
_ALL_DIGITS_WIDE = (
    r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨"
    r"⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾"
    r"➀-➈➊-➒]+$"
)


def trim_space(c: Column) -> Column:
    """Strip Unicode white space from both ends (``F.trim`` strips blanks only)."""
    return F.regexp_replace(c, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def fold_space(c: Column) -> Column:
    """Collapse white space runs to one blank and trim."""
    return F.trim(F.regexp_replace(c, rf"(?U){_SPACE}+", " "))


def clean_text(c: Column) -> Column:
    """Tags to blanks, white space collapsed, null to ''. Entities stay as they are."""
    text = F.coalesce(c, F.lit(""))
    untagged = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, _TAG, " ")).otherwise(text)
    return fold_space(untagged)


def or_default(c: Column, default: str) -> Column:
    """The trimmed text, or ``default`` where that is null or empty."""
    return F.coalesce(F.nullif(trim_space(c), F.lit("")), F.lit(default))


def object_id(url: Column) -> Column:
    return F.sha1(url)


def batch_tokens(c: Column) -> Column:
    """Lower-case runs of ASCII letters, digits and Arabic; anything else separates.

    The array may hold empty strings at its ends; ``is_batch_candidate`` drops them.
    """
    return F.split(F.lower(c), _BATCH_SEPARATORS)


MIN_BATCH_CHARS = 4
MIN_SPEED_CHARS = 3


def is_batch_candidate(tok: Column) -> Column:
    return (F.length(tok) >= MIN_BATCH_CHARS) & ~tok.rlike(_ALL_DIGITS)


def language_group(lang: Column) -> Column:
    """fr, en or ar by prefix; 'any' for null and every other language."""
    group = F.when(lang.startswith("fr"), "fr").when(lang.startswith("en"), "en")
    return group.when(lang.startswith("ar"), "ar").otherwise("any")


def is_stopword(tok: Column, group: Column) -> Column:
    """Stopword of its language group; of any of the three lists for 'any'."""
    in_list = {g: tok.isin(*words) for g, words in STOPWORDS.items()}
    chosen = F.when(group == "fr", in_list["fr"]).when(group == "en", in_list["en"])
    union = tok.isin(*STOPWORDS_FR, *STOPWORDS_EN, *STOPWORDS_AR)
    return chosen.when(group == "ar", in_list["ar"]).otherwise(union)


def speed_tokens(c: Column) -> Column:
    """Words of the speed path: accents, underscores and apostrophes are kept."""
    return F.regexp_extract_all(F.lower(c), F.lit(_SPEED_WORD), F.lit(1))


def is_speed_candidate(tok: Column) -> Column:
    return (F.length(tok) >= MIN_SPEED_CHARS) & ~tok.rlike(_ALL_DIGITS_WIDE)


def title_and_content(titre: Column, contenu: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(titre, F.lit("")), F.coalesce(contenu, F.lit("")))
