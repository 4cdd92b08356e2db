"""Text expressions: white space, flags, term and phrase matching, tokens and proximity. All stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: white space as in RE2, which leaves out the vertical tab
SPACE = "[ \\t\\n\\f\\r]"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns that are computed once per row. Plain projections are merged and filters pushed into
    them, which repeats an expensive expression wherever it is used; a generator of one row is a border to both."""
    for name, value in columns.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df


def collapse(text: Column) -> Column:
    """Every run of white space as one blank."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def strip_links(text: Column) -> Column:
    return F.regexp_replace(text, "https?://[^ \\t\\n\\f\\r]+", " ")


def phrase_regex(phrase: str) -> str:
    """Matches the phrase in lower-cased text where no letter a-z or digit adjoins; blanks stand for any white space."""
    words = [re.sub(r"([.+*?()\[\]{}|^$\\])", r"\\\1", word) for word in phrase.strip().lower().split()]
    return f"(^|[^a-z0-9]){f'{SPACE}+'.join(words)}([^a-z0-9]|$)"


def has_phrase(lowered: Column, phrase: str) -> Column:
    # the pattern is tried only where its longest word occurs at all
    return lowered.contains(max(phrase.lower().split(), key=len)) & lowered.rlike(phrase_regex(phrase))


def has_term(lowered: Column, term: str) -> Column:
    """A term of letters and digits as a whole word, any other term as a substring."""
    term = term.lower()
    whole = lowered.rlike(f"(^|[^a-z0-9]){term}([^a-z0-9]|$)") if re.fullmatch("[a-z0-9]+", term) else F.lit(True)
    return lowered.contains(term) & whole


def tokens(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit("([a-z0-9]+)"), 1)


def positions(words: Column, term: str) -> Column:
    """Where the term, itself one or several tokens, begins in the token array (0-based)."""
    wanted = re.findall("[a-z0-9]+", term.lower())
    if not wanted:
        return F.array().cast("array<int>")
    places = F.when(F.size(words) >= len(wanted), F.sequence(F.lit(0), F.size(words) - len(wanted))).otherwise(F.array().cast("array<int>"))

    def fits(i: Column) -> Column:
        ok = F.get(words, i) == wanted[0]
        for k, word in enumerate(wanted[1:], 1):
            ok = ok & (F.get(words, i + k) == word)
        return ok

    return F.filter(places, fits)


def near(words: Column, anchors: Sequence[str], evidence: Sequence[str], window: int) -> Column:
    """Whether some anchor and some evidence begin within ``window`` tokens of each other."""

    def starts(terms: Sequence[str]) -> Column:
        return F.array(*[F.lit(re.findall("[a-z0-9]+", t.lower())[0]) for t in terms])

    def test(w: Column) -> Column:
        a = F.flatten(F.array(*[positions(w, t) for t in anchors]))
        b = F.flatten(F.array(*[positions(w, t) for t in evidence]))
        hit = F.exists(a, lambda i: F.exists(b, lambda j: F.abs(i - j) <= window))
        return F.when(F.arrays_overlap(w, starts(anchors)) & F.arrays_overlap(w, starts(evidence)), hit).otherwise(False)

    # bound to a variable, so that the tokens are made once and not again for every position
    return F.get(F.transform(F.array(words), test), 0)


def is_deleted(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)) == "[deleted]", F.lit(False))


def is_removed(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)) == "[removed]", F.lit(False))


def is_bot(author: Column, text: Column, phrases: Sequence[str], trimmed: bool = False) -> Column:
    """By the author's name (``automoderator``, or ``bot`` as a part set off by other signs than letters) or by how the
    text begins. ``trimmed`` ignores blanks around the text."""
    name, start = F.lower(author), F.lower(F.trim(text) if trimmed else text)
    by_name = (name == "automoderator") | name.rlike("(^|[^a-z])bot([^a-z]|$)")
    return F.coalesce(by_name, F.lit(False)) | F.coalesce(start.rlike(f"^({'|'.join(phrases)})"), F.lit(False))


def is_whole(text: Column, lowest: int) -> Column:
    return F.length(text) >= lowest
