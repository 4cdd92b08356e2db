"""Personal information inside free text, by bootstrapped contextual extraction.

Seeds need no learning: international phone numbers, numbers next to the name of an identity document,
street names with a house number, family names after a title, full names with a middle initial. The words around seeds
become patterns. Patterns and the forms (of numbers) or words (of names) met in them make up a graph, which Spark scores in turns: a pattern is as good
as the share of its instances that are known, an instance as good as the patterns it occurs in. Forms and words that
good patterns bring up are used like seeds from then on, so identifiers of unseen forms and unseen names are found
wherever they stand. Three passes over the texts: contexts of seeds, instances in these contexts, detection.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.scratch import materialize, release

# fixed values: seeds
ID_CUES = ["ssn", "social security", "passport", "nino", "national insurance", "ni number", "identity card", "id card", "national id", "driving licence", "driver's licence", "driver's license", "license number", "licence number", "tax id", "taxpayer", "cpf"]
STREETS = ["street", "road", "avenue", "lane", "rue", "calle", "strasse", "straße", "box"]
TITLES = ["mr", "mrs", "ms", "miss", "dr", "prof", "herr", "frau", "señor", "señora", "sra", "mme"]
#: what people write before their own name or that of an addressee
NAME_CUES = ["my name is", "regards,", "sincerely,", "signed:", "signed by", "attn:", "mein name ist", "me llamo", "mi nombre es", "je m'appelle", "meu nome é"]
#: a cue counts like so many known names out of one more
CUE_WEIGHT = 10
#: what a pair with capitals of which nothing is known counts against a context; one in lower case counts 1
UNKNOWN = 0.5
#: characters that are looked at first for the words around an item, before all of the text
NEAR = 80
#: entries that a task counts before it hands them on
MOST_HELD = 200_000
#: share from which a context, or a word, is taken for one of names
GOOD = 0.5

# fixed values: words with a capital at the start of a sentence that go on after a name
FUNCTION_WORDS = set("a all also an and any are as at both but by can could did do does for from good had has have he hello her here hi his how however i if in is it its last later let maybe my never next no not now of on once one only or our out please she since so some sorry still than thank thanks that the their then there these they this those though to today we well were what when where which while who why will with would yes yet you your".split())

# fixed values: abbreviations, after which a sentence goes on
SHORT = {"no.", "nr.", "mr.", "mrs.", "ms.", "dr.", "prof.", "tel."}

WORD = r"[^\W\d_]+"
AT = r"\s?(?:@|\(at\)|\[at\]|\{at\})\s?"
LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
DOT = r"(?:\.|\s(?:dot|\(dot\)|\[dot\])\s|\(dot\)|\[dot\])"
LOCAL = regex.compile(rf"(?ri)(?<![\w./@+-])[\w+-]+(?:{DOT}[\w+-]+)*")
DOMAIN = regex.compile(rf"(?i)(?:{AT}{LABEL}(?:{DOT}{LABEL})*?{DOT}|\sat\s{LABEL}(?:\sdot\s{LABEL})*?\sdot\s)[a-z-]{{2,}}(?:{DOT}(?:com|org|net|edu|gov|co|uk|de|fr|es|br|ru|jp))?(?![\w-])")
#: digits with what may stand between and before them, on one line
RUN = re.compile(r"\d[\d\-./ ()]*")
DIGITS = r"\(?\d(?:\d|[-./ ]\(?(?=\d)|\)[- ]?(?=\d))*"
#: as whole words: those who write of renewing passports give no number
CUE = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, ID_CUES))})(?!\w)")
LETTERED = regex.compile(rf"(?<![\w-])(?!ID\b|NO\b)[A-Z]{{1,3}}[- ]?{DIGITS}(?:[- ]?[A-Z](?!\w))?(?!\w)")
PLAIN = regex.compile(rf"(?<![\w.,/#@$£€¥-])\+?{DIGITS}(?:-?[A-Z](?!\w))?(?!\w)")
#: a house number and what goes with it: behind the number, or before it
BEHIND = regex.compile(rf"(?<![\w.,$£€¥/-])(\d{{1,5}})[A-Za-z]?\s({WORD})\s({WORD})(?!\w)")
HOUSE = regex.compile(rf"\d{{1,5}}[A-Za-z]?\s{WORD}\s{WORD}(?!\w)")
BEFORE = regex.compile(rf"(?ri)(?<!\w)(?:(calle|via|rua|avenida|plaza)\s{WORD}|{WORD}?(stra(?:ss|ß)e|gasse|weg|platz)|((?:p\.?\s?o\.?\s?)?box|postfach|apartado))\s")
FLAT = regex.compile(r"(?ri)(?<!\w)(?:flat|apt|apartment|unit|suite)\.?\s\d{1,4}\w?,?\s")
BACK, AHEAD = regex.compile(r"(?r)\S{1,100}"), regex.compile(r"\S{1,100}")
TITLED = regex.compile(rf"\.?\s({WORD})")
#: a name by its form alone: given name, initial and family name
FULL = regex.compile(r"(?<!\w)(\p{Lu}\p{L}+)\s\p{Lu}\.\s(\p{Lu}\p{L}+)(?!\w)")
PAIR = regex.compile(rf"[^\w]{{0,3}}({WORD}\.?)(?:(,\s)|\s(?:\p{{L}}\.\s)?)({WORD})(?!\w)")
PAIR_BEFORE = regex.compile(rf"(?r)(?<!\w)({WORD}\.?)(?:(,\s)|\s(?:\p{{L}}\.\s)?)({WORD})[^\w]{{1,3}}")
RUNS = regex.compile(r"[^\W_]+")
CAP = {"phone": "[PHONE]", "email": "[EMAIL]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}


def _automaton(words) -> ahocorasick.Automaton | None:
    made = ahocorasick.Automaton()
    for word in words:
        made.add_word(word, word)
    if not len(made):
        return None
    made.make_automaton()
    return made


_marks = _automaton([*TITLES, "@", "(at)", "[at]", "{at}"])


def _lowered(text: str) -> str:
    """In lower case, character by character, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _alone(text: str, start: int, end: int) -> bool:
    return not (start and (text[start - 1].isalnum() or text[start - 1] == "_")) and not (end < len(text) and (text[end].isalnum() or text[end] == "_"))


def _before(low: str, start: int, many: int) -> list[str]:
    """The last ``many`` words before ``start``, in order. A word is at most 100 characters here, so that a text without
    blanks is not read again for each of its numbers; items themselves may be of any length."""
    # mostly enough is near; the first word there may be cut
    near = low[max(0, start - NEAR) : start].split()
    if len(near) > many or start <= NEAR:
        return near[-many:]
    words: list[str] = []
    for m in BACK.finditer(low, 0, start):
        words.append(m.group())
        if len(words) == many:
            break
    return words[::-1]


def _left(low: str, start: int, many: int) -> list[str]:
    """The words before, of the same sentence; ``^`` for its start."""
    words = _before(low, start, many)
    for i in range(len(words) - 1, -1, -1):
        if words[i][-1] in ".!?" and words[i] not in SHORT:
            return ["^", *words[i + 1 :]]
    return ["^", *words] if len(words) < many else words


def _right(text: str, low: str, end: int, many: int) -> list[str]:
    """The words after, of the same sentence. Capitalised ones that follow directly are passed over, as they vary."""
    if end < len(low) and low[end] in ".!?":
        return ["$"]
    stop = end + NEAR
    near = low[end:stop].split()
    if stop < len(low):
        del near[-1:]  # it may be cut
    shown = text[end:stop].split()
    words, over = _following(((w, shown[i][0].isupper() and (stop < len(low) or i + 1 < len(near))) for i, w in enumerate(near)), many)
    if over or stop >= len(low):
        return words
    return _following(((m.group(), text[m.start()].isupper() and m.end() < len(low)) for m in AHEAD.finditer(low, end)), many)[0]


def _following(words: Iterable[tuple[str, bool]], many: int) -> tuple[list[str], bool]:
    """The first ``many`` words, without those passed over at the start, up to the end of the sentence; and whether that is
    all there is to know."""
    out: list[str] = []
    for word, passed in words:
        if passed and not out:
            if word[-1] in ".!?":
                return ["$"], True
            continue
        out.append(word)
        if word[-1] in ".!?":
            return [*out, "$"], True
        if len(out) == many:
            return out, True
    return out, False


def shape(number: str) -> str:
    """``d`` for a digit, ``0`` for leading zeros (they tell a trunk or country prefix), letters and marks as they are."""
    plain = re.sub(r"[A-Z]", "L", number)
    zeros = min(2, len(plain) - len(plain.lstrip("0")))
    return "0" * zeros + re.sub(r"\d", "d", plain[zeros:])


def _is_phone(form: str) -> bool:
    digits = form.count("d") + form.count("0")
    return "L" not in form and 9 <= digits <= 15 and (form[0] == "+" or form == "(ddd) ddd-dddd")


def _seed_type(kind: str, form: str, left: list[str], right: list[str]) -> str | None:
    if kind == "house":
        parts = form.replace("*", " ").split()
        return "address" if any(street in parts for street in STREETS) or form in ("pobox n", "postfach n") else None
    if _is_phone(form):
        return "phone"
    around = " ".join([*left, "|", *right])
    return "id_number" if CUE.search(around) else None


def _marked(text: str, low: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, str]]]:
    """Email addresses, and titled names with their family name."""
    places, titled = [], []
    for last, mark in _marks.iter(low):
        if mark in TITLES:
            start, end = last - len(mark) + 1, last + 1
            if _alone(low, start, end) and (m := TITLED.match(text, end)) and m.group(1)[0].isupper() and len(m.group(1)) > 1 and m.group(1).lower() not in TITLES:
                titled.append((start, m.end(), m.group(1).lower()))
        else:
            places.append(last - len(mark) + 1)
    if " dot " in low:
        places += [m.start() for m in re.finditer(" at ", low)]
    emails = []
    for place in places:
        begin = place - 1 if place and text[place - 1].isspace() and text[place] != " " else place
        local = LOCAL.match(text, 0, begin)
        domain = DOMAIN.match(text, begin)
        if local and domain and local.end() == begin:
            emails.append((local.start(), domain.end()))
    return emails, [t for t in titled if not any(b < t[1] and t[0] < e for b, e in emails)]


def _full_names(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """Start, end, given and family name of the names that are known by their form."""
    found = [(m.start(), m.end(), m.group(1).lower(), m.group(2).lower()) for m in FULL.finditer(text)] if ". " in text else []
    return [x for x in found if not {x[2], x[3]} & FUNCTION_WORDS and x[2] not in TITLES and not any(b < x[1] and x[0] < e for b, e in taken)]


def _seeded(kind: str, form: str) -> bool:
    return _seed_type(kind, form, [], []) is not None


def _digits(text: str) -> int:
    return sum(map(str.isdigit, text))


def _number_at(text: str, start: int, floor: int) -> regex.Match | None:
    """The number whose first digit is at ``start``, with letters and marks before it, but none before ``floor``."""
    begin = start
    while begin > floor and start - begin < 4 and (text[begin - 1].isupper() or text[begin - 1] in "- "):
        begin -= 1
    for first in range(begin, start):
        # letters set off from the digits belong to them only if a letter closes the number
        if (m := LETTERED.match(text, first)) and (" " not in m.group()[:4] or m.group()[-1].isupper()):
            return m
    first = start - (start > floor and text[start - 1] == "(")
    return PLAIN.match(text, first - (first > floor and text[first - 1] == "+")) or PLAIN.match(text, start)


def _house_at(text: str, start: int, floor: int) -> tuple[str, int, int] | None:
    """Form, start and end of what may be a house with its number at ``start``."""
    if start > floor and text[start - 1].isspace() and (m := BEFORE.match(text, floor, start)):
        if number := re.compile(r"\d{1,6}(?!\d)").match(text, start):
            street, suffix, box = m.groups()
            form = f"{street.lower()} * n" if street else f"*{suffix.lower()} n" if suffix else f"{re.sub('[^a-z]', '', box.lower())} n"
            return form, m.start(), number.end()
    elif m := BEHIND.match(text, start):
        _, middle, head = m.groups()
        flat = FLAT.match(text, floor, start)
        return f"n {middle.lower()} *" if middle.lower() == "rue" else f"n * {head.lower()}", flat.start() if flat else start, m.end()
    return None


def _pieces(text: str, start: int, end: int, known: Callable[[str, str], bool]) -> list[tuple[int, int]] | None:
    """Known numbers that stand in a row from ``start`` to ``end``, set apart by one blank or slash. The last may be that of
    a house, the first a short one of whatever kind; None if something else is left over."""
    cuts = [i for i in range(start, end) if text[i] in " /"]
    for cut in [end, *reversed(cuts)]:
        if _digits(text[start:cut]) >= 6 and known("number", shape(text[start:cut])):
            if cut == end or (cut == cuts[-1] and HOUSE.match(text, cut + 1)):
                return [(start, cut)]
            if rest := _pieces(text, cut + 1, end, known):
                return [(start, cut), *rest]
    if cuts and cuts[0] - start <= 3 and text[start:cuts[0]].isdigit():
        return _pieces(text, cuts[0] + 1, end, known)
    return None


def _numbers(text: str, taken: list[tuple[int, int]], known: Callable[[str, str], bool] = _seeded) -> list[tuple[str, str, int, int]]:
    """kind, form, start and end of what may be a number of somebody, or a house. A run of digits and marks may hold
    several; what looks like one number of a form that is not ``known`` is taken apart where all its parts are."""
    out, upto = [], 0
    for run in RUN.finditer(text):
        at, stop, fresh = max(run.start(), upto), run.end(), True
        while at < stop:
            if not text[at].isdigit():
                at += 1
                continue
            if clash := [e for b, e in taken if b <= at < e]:
                at = max(clash)
                continue
            house = _house_at(text, at, upto)
            m = _number_at(text, at, upto) if _digits(text[at:stop]) >= 6 else None
            if m and _digits(m.group()) >= 6 and not any(b < m.end() and m.start() < e for b, e in taken):
                form, cut = shape(m.group()), m.group().rfind(" ")
                # a house number after a blank is no end of a number
                tail = m.start() + cut + 1
                ends_in_house = cut > 0 and known("number", shape(m.group()[:cut])) and (last := _house_at(text, tail, tail)) and known("house", last[0])
                parts = [(m.start(), tail - 1)] if ends_in_house else [m.span()] if known("number", form) else _pieces(text, *m.span(), known)
                if not parts and fresh and not (house and known("house", house[0])):
                    parts = [m.span()]
                if parts:
                    out += [("number", shape(text[b:e]), b, e) for b, e in parts]
                    at = upto = parts[-1][1]
                    fresh = True
                    continue
            if house and (fresh or known("house", house[0])):
                out.append(("house", *house))
                at = upto = house[2]
                continue
            # only what is known is looked for after a start that gave nothing
            fresh = False
            while at < stop and text[at] not in " /":
                at += 1
    return out


def _contexts(docs: DataFrame) -> DataFrame:
    """First pass: ``kind, form, side, pattern, seed, n``: how often a form stood in a context. Names after a title and
    full names have kind ``title`` and the family name as their form, the given names among them kind ``given``."""

    def counted(found: Counter) -> pa.RecordBatch:
        columns = list(zip(*found))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in columns], pa.array(list(found.values()), pa.int64())], names=["kind", "form", "side", "pattern", "seed", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                low = _lowered(text)
                emails, titled = _marked(text, low)
                cued = CUE.search(low)
                for kind, form, start, end in _numbers(text, emails):
                    # a cue may stand further off than a pattern reaches
                    far = bool(cued) and kind == "number"
                    left, right = _left(low, start, 4 if far else 2), _right(text, low, end, 5 if far else 3)
                    seed = _seed_type(kind, form, left, right)
                    found[kind, form, "l", " ".join(left[-2:]), seed] += 1
                    found[kind, form, "r", " ".join(right[:3]), seed] += 1
                full = _full_names(text, emails)
                for _, _, given, _ in full:
                    found["given", given, "", "", "name"] += 1
                for start, end, family in [*titled, *((b, e, family) for b, e, _, family in full)]:
                    found["title", family, "l", " ".join(_left(low, start, 2)), "name"] += 1
                    found["title", family, "r", " ".join(_right(text, low, end, 2)[:2]), "name"] += 1
            if len(found) > MOST_HELD:
                yield counted(found)
                found.clear()
        if found:
            yield counted(found)

    parts = docs.select("text").mapInArrow(work, "kind string, form string, side string, pattern string, seed string, n long")
    return materialize(parts.groupBy("kind", "form", "side", "pattern", "seed").agg(F.sum("n").alias("n")), "contexts")


def _score_forms(contexts: DataFrame, rounds: int) -> DataFrame:
    """``kind, form, type`` of the forms that belong to persons without a cue, after some rounds on the graph of forms and
    patterns. Numbers of other forms, or of forms shared with things, count where a cue stands beside them. A pattern and
    a form are judged by shares with a constant added, so nothing hangs on the size of the corpus."""
    edges = contexts.filter("kind NOT IN ('title', 'given')")
    weight = edges.groupBy("kind", "form", "side", "pattern").agg(F.sum("n").alias("n"))
    totals = weight.filter("side = 'l'").groupBy("kind", "form").agg(F.sum("n").alias("all"))
    seeds = edges.filter("seed IS NOT NULL AND side = 'l'").groupBy("kind", "form", F.col("seed").alias("type")).agg(F.sum("n").alias("m"))
    # a form is a seed of a type as far as it occurs as one
    scores = seeds.join(totals, ["kind", "form"]).select("kind", "form", "type", (F.col("m") / F.col("all")).alias("score"))
    base = scores.withColumnRenamed("score", "base")
    variety = weight.groupBy("kind", "form", "side").agg(F.count(F.lit(1)).alias("contexts"))
    for _ in range(rounds):
        known = weight.join(scores, ["kind", "form"])
        mass = weight.groupBy("kind", "side", "pattern").agg(F.sum("n").alias("mass"))
        patterns = known.groupBy("kind", "side", "pattern", "type").agg(F.sum(F.col("n") * F.col("score")).alias("good")).join(mass, ["kind", "side", "pattern"])
        # a pattern met once or twice says little
        patterns = patterns.select("kind", "side", "pattern", "type", (F.col("good") / (F.col("mass") + 1)).alias("quality"))
        # each context counts once, as copies of a text repeat it; the better of the two sides counts
        support = weight.join(patterns, ["kind", "side", "pattern"]).groupBy("kind", "form", "side", "type").agg(F.sum("quality").alias("got"))
        support = support.join(variety, ["kind", "form", "side"]).withColumn("got", F.col("got") / (F.col("contexts") + F.lit(0.5)))
        support = support.groupBy("kind", "form", "type").agg(F.max("got").alias("got"))
        scores = support.join(base, ["kind", "form", "type"], "full").select("kind", "form", "type", F.coalesce("got", F.lit(0.0)).alias("got"), F.greatest(F.coalesce("got", F.lit(0.0)), F.coalesce("base", F.lit(0.0))).alias("score"))
        # forms that are known by now count in full
        scores = materialize(scores.withColumn("score", F.when(F.col("score") >= GOOD, 1.0).otherwise(F.col("score"))), "forms")
    best = scores.groupBy("kind", "form").agg(F.max(F.struct("score", "got", "type")).alias("s"))
    return best.filter(F.col("s.score") >= GOOD).select("kind", "form", F.col("s.type").alias("type"))


class _Pairs:
    """Pairs of words in the given contexts of a text."""

    def __init__(self, patterns: Iterable[tuple[str, str]]):
        patterns = set(patterns)
        self.left = _automaton(p for s, p in patterns if s == "l")
        self.right = _automaton(p for s, p in patterns if s == "r")

    def __call__(self, text: str, low: str) -> Iterator[tuple[str, str, regex.Match]]:
        for side, automaton in (("l", self.left), ("r", self.right)):
            for last, pattern in automaton.iter(low) if automaton else ():
                start, end = last - len(pattern) + 1, last + 1
                # a mark stands by itself, a word may follow a bracket or quotation mark
                if start and (low[start - 1].isalnum() if pattern[0].isalnum() else not low[start - 1].isspace()) or (end < len(low) and low[end].isalnum() and pattern[-1].isalnum()):
                    continue
                pair = PAIR.match(text, end) if side == "l" else PAIR_BEFORE.match(text, 0, start)
                if pair:
                    yield side, pattern, pair


def _parts(pair: regex.Match) -> tuple[str, str] | None:
    """Given and family name of a pair, as its order and comma tell."""
    first, comma, second = pair.groups()
    given, family = (second, first) if comma else (first, second)
    return None if family[-1] == "." or (given[-1] == "." and len(given) > 2) else (given, family)


@dataclass
class Knowledge:
    """What the corpus taught, as far as a task needs it: types of number and house forms that need no cue, words of names
    and the contexts of names."""

    forms: dict[tuple[str, str], str] = field(default_factory=dict)
    givens: set[str] = field(default_factory=set)
    families: set[str] = field(default_factory=set)
    contexts: set[tuple[str, str]] = field(default_factory=set)

    def add(self, what: str, a: str, b: str, value: str | None) -> None:
        if what == "form":
            self.forms[a, b] = value
        elif what == "context":
            self.contexts.add((a, b))
        else:
            (self.givens if what == "given" else self.families).add(a)


KNOWN = "what string, a string, b string, value string"


def _anchor(what: str, a: str, b: str) -> str:
    """A run of letters and digits that a text must have for an entry to matter; empty if there is none to be named."""
    if what == "form":
        return b[4:] if b.startswith("n * ") else ""
    return max(RUNS.findall(b if what == "context" else a), key=len, default="")


def _taught(table: DataFrame, docs: DataFrame, text: str, make: Callable, schema: T.StructType | str, most: int) -> DataFrame:
    """``docs`` through ``make(knowledge)``, which gives a function of a batch and one that ends the work, each returning
    batches. A ``table`` of knowledge of up to ``most`` rows is broadcast. Of a larger one every chunk of the documents
    gets the entries whose anchors its own texts hold: these are joined in Spark and meet the chunk in its task, so what a
    task holds is bounded by its texts, and the result is the same."""
    rows = table.limit(most + 1).collect()
    if len(rows) <= most:
        known = Knowledge()
        for r in rows:
            known.add(*r)
        shared = docs.sparkSession.sparkContext.broadcast(known)

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            feed, finish = make(shared.value)
            for batch in batches:
                yield from feed(batch)
            yield from finish()

        return docs.mapInArrow(whole, schema)

    del rows
    parted = materialize(docs.withColumn("_chunk", F.spark_partition_id()), "chunks")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, str]] = set()
        for batch in batches:
            new = set()
            for chunk, words in zip(batch.column("_chunk").to_pylist(), batch.column(text).to_pylist()):
                new.update((chunk, w) for w in ("", *RUNS.findall(_lowered(words or ""))))
            new -= seen
            seen |= new
            if len(seen) > MOST_HELD:
                seen.clear()
            if new:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in new], pa.int32()), pa.array([w for _, w in new], pa.string())], names=["_chunk", "_anchor"])

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            what, a, b = (batch.column(c).to_pylist() for c in ("what", "a", "b"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(map(_anchor, what, a, b)), pa.string())], names=[*batch.schema.names, "_anchor"])

    asked = parted.select("_chunk", text).mapInArrow(anchors, "_chunk int, _anchor string").distinct()
    held = asked.join(table.mapInArrow(anchored, f"{KNOWN}, _anchor string"), "_anchor").select("_chunk", F.struct("what", "a", "b", "value").alias("_known"))
    doc = F.struct(*[F.col(c) for c in docs.columns]).alias("_doc")
    both = held.withColumn("_doc", F.lit(None).cast(T.StructType(docs.schema.fields))).unionByName(parted.select("_chunk", F.lit(None).cast(f"struct<{', '.join(c.replace(' ', ': ') for c in KNOWN.split(', '))}>").alias("_known"), doc))
    n = parted.agg(F.max("_chunk")).first()[0]
    met = both.repartition((n or 0) + 1, "_chunk").sortWithinPartitions("_chunk", F.col("_doc").isNotNull())

    def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, known, feed, finish = None, Knowledge(), None, None
        for batch in batches:
            chunks = batch.column("_chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1), batch.num_rows]
            for b, e in zip(cuts, cuts[1:]):
                if e == b:
                    continue
                if chunks[b] != chunk:
                    if finish:
                        yield from finish()
                    chunk, known, feed, finish = chunks[b], Knowledge(), None, None
                part = batch.slice(b, e - b)
                for r in part.column("_known").drop_null().to_pylist():
                    known.add(r["what"], r["a"], r["b"], r["value"])
                if found := part.column("_doc").drop_null():
                    if not feed:
                        feed, finish = make(known)
                    yield from feed(pa.RecordBatch.from_arrays(found.flatten(), names=[f.name for f in found.type]))
        if finish:
            yield from finish()

    return met.mapInArrow(by_chunk, schema)


def _instances(docs: DataFrame, table: DataFrame, most: int) -> DataFrame:
    """Second pass: pairs of words in the contexts of ``table``: ``side, pattern, given, family, n, capital``, and with side
    ``w`` how often each of its words stands in the texts (as ``family``), and how often with a capital."""

    def make(known: Knowledge) -> tuple[Callable, Callable]:
        pairs, words = _Pairs(known.contexts), _automaton(known.families)
        found: Counter = Counter()
        capital: Counter = Counter()

        def finish() -> list[pa.RecordBatch]:
            if not found:
                return []
            numbers = [pa.array(list(found.values()), pa.int64()), pa.array([capital[k] for k in found], pa.int64())]
            out = pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in zip(*found)], *numbers], names=["side", "pattern", "given", "family", "n", "capital"])
            found.clear()
            capital.clear()
            return [out]

        def feed(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
            for text in batch.column("text").to_pylist():
                low = _lowered(text)
                for side, pattern, pair in pairs(text, low):
                    if parts := _parts(pair):
                        given, family = parts
                        key = side, pattern, given.lower(), family.lower()
                        found[key] += 1
                        capital[key] += given[0].isupper() and family[0].isupper()
                for last, word in words.iter(low) if words else ():
                    start = last - len(word) + 1
                    if _alone(text, start, last + 1):
                        key = "w", "", "", word
                        found[key] += 1
                        capital[key] += text[start].isupper()
            return finish() if len(found) > MOST_HELD else []

        return feed, finish

    rows = _taught(table, docs.select("text"), "text", make, "side string, pattern string, given string, family string, n long, capital long", most)
    return materialize(rows.groupBy("side", "pattern", "given", "family").agg(F.sum("n").alias("n"), F.sum("capital").alias("capital")), "instances")


def _score_names(docs: DataFrame, contexts: DataFrame, rounds: int, most: int) -> DataFrame:
    """Given names, family names and contexts of names as rows of knowledge: from titles, full names and the contexts that
    these share with others.

    All tests are shares with a constant added, so that little evidence counts little but nothing hangs on the size of
    the table: of the pairs in a context those with a known part, of the pairs of a word the quality of their contexts.
    """
    spark = docs.sparkSession
    seeds = contexts.filter("kind IN ('title', 'given') AND length(form) > 1")
    seeds = materialize(seeds.groupBy(F.col("form").alias("word")).agg(F.max(F.expr("kind = 'given'")).alias("as_given"), F.max(F.expr("kind = 'title' AND length(form) > 2")).alias("as_family")), "seeds")
    shared = contexts.filter("kind = 'title'").filter("pattern LIKE '% %' AND NOT pattern LIKE '%$'").withColumn("pattern", F.regexp_replace("pattern", "^\\^ ", ""))
    cues = spark.createDataFrame([("l", cue) for cue in NAME_CUES], "side string, pattern string")
    patterns = materialize(shared.select("side", "pattern").unionByName(cues).distinct(), "patterns")
    none = F.lit(None).cast("string")
    table = patterns.select(F.lit("context").alias("what"), F.col("side").alias("a"), F.col("pattern").alias("b"), none.alias("value"))
    table = table.unionByName(seeds.select(F.lit("family").alias("what"), F.col("word").alias("a"), none.alias("b"), none.alias("value")))
    counted = _instances(docs, table, most)
    # names are mostly written with capitals
    proper = F.sum("capital") * 2 >= F.sum("n")
    lower = counted.filter("side = 'w' AND capital * 2 < n").select(F.col("family").alias("word"))
    named = seeds.join(lower, "word", "left_anti")
    givens, families = named.filter("as_given").select("word"), named.filter("as_family").select("word")
    edges = counted.filter("side <> 'w'").filter(~F.col("given").isin(TITLES) & ~F.col("family").isin(TITLES))
    cue = F.when((F.col("side") == "l") & F.col("pattern").isin(NAME_CUES), CUE_WEIGHT).otherwise(0)

    def rate() -> DataFrame:
        marked = edges.join(givens.withColumn("g", F.lit(1)), edges.given == givens.word, "left").drop("word")
        marked = marked.join(families.withColumn("f", F.lit(1)), F.col("family") == F.col("word"), "left").drop("word")
        marked = marked.withColumn("known", F.coalesce("g", "f", F.col("given").endswith(".").cast("int"), F.lit(0)))
        quality = marked.groupBy("side", "pattern").agg(F.sum("known").alias("known"), F.sum(F.when((F.col("known") == 1) | (F.col("capital") * 2 < F.col("n")), 1.0).otherwise(UNKNOWN)).alias("pairs"))
        return materialize(marked.drop("known").join(quality.withColumn("quality", (F.col("known") + cue) / (F.col("pairs") + 1 + cue)), ["side", "pattern"]), "rated")

    def taken(rated: DataFrame, word: str, partner: str) -> DataFrame:
        # a known partner vouches for half of what the context leaves open
        value = F.when(F.expr(partner), (F.col("quality") + 1) / 2).otherwise(F.col("quality"))
        scored = rated.groupBy(F.col(word).alias("word")).agg((F.sum(value) / (F.count(F.lit(1)) + F.lit(0.5))).alias("score"), proper.alias("proper"))
        return scored.filter((F.col("score") >= GOOD) & F.col("proper") & ~F.col("word").isin(sorted(FUNCTION_WORDS)))

    for _ in range(rounds):
        rated = rate()
        more = taken(rated, "given", "f = 1").filter("length(word) > 1 AND NOT word LIKE '%.'")
        near = taken(rated, "family", "g = 1 OR given LIKE '%.'").filter("length(word) > 2")
        before = givens, families
        givens = materialize(givens.unionByName(more.select("word")).distinct(), "givens")
        families = materialize(families.unionByName(near.select("word")).distinct(), "families")
        release(rated, *before)
    # a cue that no pair was met beside keeps its own weight
    unmet = F.when((F.col("side") == "l") & F.col("pattern").isin(NAME_CUES), CUE_WEIGHT / (CUE_WEIGHT + 1)).otherwise(0.0)
    quality = rate().groupBy("side", "pattern").agg(F.max("quality").alias("quality"))
    good = patterns.join(quality, ["side", "pattern"], "left").filter(F.coalesce("quality", unmet) >= GOOD)
    out = good.select(F.lit("context").alias("what"), F.col("side").alias("a"), F.col("pattern").alias("b"), none.alias("value"))
    for what, words in (("given", givens), ("family", families)):
        out = out.unionByName(words.select(F.lit(what).alias("what"), F.col("word").alias("a"), none.alias("b"), none.alias("value")))
    return out


@dataclass
class Learnt:
    """Knowledge as a table ``what, a, b, value``, of any size; ``most`` rows of it may be broadcast."""

    table: DataFrame
    most: int

    def collect(self) -> Knowledge:
        """All of it in one place: for small corpora and for looking at."""
        known = Knowledge()
        for r in self.table.collect():
            known.add(*r)
        return known


def learn(docs: DataFrame, text: str, rounds: int = 4, most: int = 500_000) -> Learnt:
    """Learns from ``docs[text]``, null texts left out. Nothing is dropped or refused: up to ``most`` rows of what is learnt
    are broadcast, and beyond that the documents are joined with it by chunk."""
    rows = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL AND text <> ''")
    contexts = _contexts(rows)
    forms = _score_forms(contexts, rounds).select(F.lit("form").alias("what"), F.col("kind").alias("a"), F.col("form").alias("b"), F.col("type").alias("value"))
    return Learnt(materialize(forms.unionByName(_score_names(rows, contexts, rounds, most)), "known"), most)


class Finder:
    """Items of one text after another."""

    def __init__(self, known: Knowledge):
        self.forms, self.givens = known.forms, known.givens
        self.families = _automaton(word for word in known.families if len(word) > 1)
        self.pairs = _Pairs(known.contexts)
        self.before = regex.compile(rf"(?r)(?<!\w)({WORD})\s(?:\p{{L}}\.\s)?")
        self.initial = regex.compile(r"(?r)(?<!\w)\p{Lu}\.\s")
        self.behind = regex.compile(rf",\s({WORD})(?!\w)")

    def _names(self, text: str, low: str) -> Iterator[tuple[int, int]]:
        for last, word in self.families.iter(low) if self.families else ():
            start, end = last - len(word) + 1, last + 1
            if not _alone(text, start, end):
                continue
            prior = self.before.match(text, 0, start)
            if not prior or prior.group(1).lower() not in self.givens:
                prior = self.initial.match(text, 0, start)
            if prior:
                yield prior.start(), end
            elif (after := self.behind.match(text, end)) and after.group(1).lower() in self.givens:
                yield start, after.end()

    def _known(self, kind: str, form: str) -> bool:
        return (kind, form) in self.forms or _seeded(kind, form)

    def _placed(self, text: str, low: str) -> Iterator[tuple[int, int]]:
        """Pairs with capitals on one line in good contexts, known or not."""
        for _, _, pair in self.pairs(text, low):
            parts = _parts(pair)
            if parts and "\n" not in text[pair.start(1) : pair.end(3)] and all(p[0].isupper() and p.lower() not in FUNCTION_WORDS and p.lower() not in TITLES for p in parts) and len(parts[1]) > 1:
                yield pair.start(1), pair.end(3)

    def items(self, text: str) -> list[tuple[int, int, str]]:
        """start, end and type, without overlaps, in order."""
        if not text:
            return []
        low = _lowered(text)
        taken, titled = _marked(text, low)
        found = [*[(b, e, "email") for b, e in taken], *[(b, e, "name") for b, e, _ in titled]]
        cued = CUE.search(low)
        for kind, form, start, end in _numbers(text, taken, self._known):
            # forms that need no context, and numbers with a cue beside them, count even where the corpus has them once
            t = self.forms.get((kind, form)) or _seed_type(kind, form, [], [])
            if t or (kind == "number" and cued and (t := _seed_type(kind, form, _left(low, start, 4), _right(text, low, end, 5)))):
                found.append((start, end, t))
        found += [(b, e, "name") for b, e, *_ in _full_names(text, taken)]
        found += [(b, e, "name") for b, e in [*self._names(text, low), *self._placed(text, low)] if not any(x < e and b < y for x, y in taken)]
        out: list[tuple[int, int, str]] = []
        for item in sorted(found, key=lambda i: (i[0], -i[1])):
            if not out or item[0] >= out[-1][1]:
                out.append(item)
        return out


def detect(docs: DataFrame, text: str, known: Learnt, keep: list[str], upto: str | None = None) -> DataFrame:
    """``keep``, ``pii_types`` (distinct types found) and ``redacted``, the text with typed placeholders.

    With ``upto``, a column with a length, only items that end within that many characters count and the text is cut
    there. A null text stays null and holds nothing, an empty one stays empty.
    """
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("pii_types", T.ArrayType(T.StringType())), T.StructField("redacted", T.StringType())])

    def make(knowledge: Knowledge) -> tuple[Callable, Callable]:
        finder = Finder(knowledge)

        def feed(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
            texts = batch.column(text).to_pylist()
            ends = batch.column(upto).to_pylist() if upto else [None] * len(texts)
            types, redacted = [], []
            for whole, end in zip(texts, ends):
                if whole is None:
                    types.append([])
                    redacted.append(None)
                    continue
                items = finder.items(whole)
                if end is not None:
                    items, whole = [i for i in items if i[1] <= end], whole[:end]
                types.append(sorted({t for _, _, t in items}))
                at, parts = 0, []
                for b, e, t in items:
                    parts += [whole[at:b], CAP[t]]
                    at = e
                redacted.append("".join([*parts, whole[at:]]))
            return [pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(types, pa.list_(pa.string())), pa.array(redacted, pa.string())], names=schema.names)]

        return feed, lambda: []

    return _taught(known.table, docs.select(*dict.fromkeys([*keep, text, *([upto] if upto else [])])), text, make, schema, known.most)


__all__ = ["CAP", "Finder", "Knowledge", "Learnt", "detect", "learn"]
