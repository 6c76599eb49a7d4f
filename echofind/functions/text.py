"""Text cleaning, tokenising and n-gram expressions.

Every function takes and returns a Spark ``Column``; none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes of Unicode whitespace and word
# characters, the tag pattern, and the filler for short documents.
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD_CHARS = r"\p{L}\p{N}_"
TAG_PATTERN = "<[^>]+>"
FILLER = " This is A Filling text"
SHORT_TEXT_WORDS = 3

# Spark ML's English stopwords, in its own order. Kept as text so
# that the list is at hand without a running session.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

SPACES = f"[{SPACE_CHARS}]+"
# The runs of white space that are not one plain space already.
ODD_SPACES = f"[{SPACE_CHARS}&&[^ ]][{SPACE_CHARS}]*| [{SPACE_CHARS}]+"
# The lookahead passes over the usual characters without asking for their Unicode category.
PUNCTUATION = f"(?![a-zA-Z0-9 ])[^{WORD_CHARS}{SPACE_CHARS}]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Catalyst inlines a computed column into every lambda that mentions it, so
    an array used inside ``transform`` would be rebuilt for each element. A
    lambda variable is evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def as_column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def strip_html(text: Column | str) -> Column:
    """Delete markup tags; nothing is put in their place."""
    return F.regexp_replace(as_column(text), TAG_PATTERN, "")


def normalize_whitespace(text: Column | str) -> Column:
    """Collapse runs of Unicode whitespace to one space and strip the ends."""
    return F.trim(F.regexp_replace(as_column(text), ODD_SPACES, " "))


def strip_punctuation(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), PUNCTUATION, "")


def words(text: Column | str) -> Column:
    """Whitespace-separated words, in order, repeats kept.

    Where a text's only white space is the plain space, as in cleaned texts, it is split
    without a pattern.
    """
    return F.array_remove(
        bind(
            as_column(text),
            lambda t: F.when(t.rlike(f"[{SPACE_CHARS}&&[^ ]]"), F.split(t, SPACES)).otherwise(F.split(t, " ")),
        ),
        "",
    )


def default_stopwords() -> list[str]:
    """Spark's own English stopword list."""
    return list(ENGLISH_STOPWORDS)


def stopword_list(
    stopwords: Iterable[str] | None = None, extra_stopwords: Iterable[str] | None = None
) -> list[str]:
    """``stopwords`` replaces the default list; otherwise ``extra_stopwords`` extends it."""
    if stopwords is not None:
        return sorted(set(stopwords))
    return sorted(set(default_stopwords()) | set(extra_stopwords or ()))


def drop_stopwords(tokens: Column, stopwords: Iterable[str]) -> Column:
    """Exact, case-sensitive removal that keeps order and repeats."""
    listed = sorted(set(stopwords))
    if not listed:
        return tokens
    return F.filter(tokens, lambda token: ~token.isin(listed))


def remove_stopwords(
    text: Column | str,
    stopwords: Iterable[str] | None = None,
    extra_stopwords: Iterable[str] | None = None,
) -> Column:
    """Drop stopwords and re-join the rest by single spaces.

    An empty stopword list leaves the text exactly as it is.
    """
    listed = stopword_list(stopwords, extra_stopwords)
    if not listed:
        return as_column(text)
    return F.array_join(drop_stopwords(words(text), listed), " ")


def pad_short_text(text: Column | str) -> Column:
    """Append the filler sentence to texts of fewer than three words."""
    source = as_column(text)
    return bind(
        source,
        lambda t: F.when(F.size(words(t)) < SHORT_TEXT_WORDS, F.concat(t, F.lit(FILLER))).otherwise(t),
    )


def clean_text(text: Column | str) -> Column:
    """Tags out, whitespace collapsed, punctuation out, lower case.

    Punctuation goes after the collapse, so ``a - b`` keeps two spaces. Null
    text stays null.
    """
    return F.lower(strip_punctuation(normalize_whitespace(strip_html(text))))


def clean_text_config(
    text: Column | str,
    remove_punctuation: bool = True,
    lowercase: bool = True,
    stopwords: Iterable[str] | None = None,
    extra_stopwords: Iterable[str] | None = None,
) -> Column:
    """Configurable cleaning with stopword removal and filling of short texts."""
    cleaned = normalize_whitespace(strip_html(text))
    if remove_punctuation:
        cleaned = strip_punctuation(cleaned)
    if lowercase:
        cleaned = F.lower(cleaned)
    return pad_short_text(remove_stopwords(cleaned, stopwords, extra_stopwords))


def tokenize(
    text: Column | str,
    stopwords: Iterable[str] | None = None,
    extra_stopwords: Iterable[str] | None = None,
) -> Column:
    """Words without stopwords; order and repeats kept."""
    return drop_stopwords(words(text), stopword_list(stopwords, extra_stopwords))


def ngrams(tokens: Column | str, n: int = 2) -> Column:
    """Word n-grams joined by one space; empty when there are fewer than ``n`` tokens."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return as_column(tokens)
    return bind(
        as_column(tokens),
        lambda t: F.when(t.isNull(), F.lit(None).cast("array<string>"))
        .when(
            F.size(t) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(t) - n),
                lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(n)]),
            ),
        )
        .otherwise(empty_strings()),
    )


def preprocess(
    text: Column | str,
    n: int = 2,
    remove_punctuation: bool = True,
    lowercase: bool = True,
    stopwords: Iterable[str] | None = None,
    extra_stopwords: Iterable[str] | None = None,
) -> Column:
    """One struct of ``cleaned_text``, ``tokens`` and ``ngrams`` per text."""
    listed = stopword_list(stopwords, extra_stopwords)

    def record(cleaned: Column) -> Column:
        return bind(
            drop_stopwords(words(cleaned), listed),
            lambda tokens: F.struct(
                cleaned.alias("cleaned_text"), tokens.alias("tokens"), ngrams(tokens, n).alias("ngrams")
            ),
        )

    return bind(clean_text_config(text, remove_punctuation, lowercase, listed), record)
