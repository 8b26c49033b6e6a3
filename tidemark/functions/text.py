"""Text rules as Columns. Patterns use (?U) where words and white space must follow Unicode."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rowwise import one_by_one

#: Shortest normalised text that is compared, real characters that a page of glyph codes needs.
LEAST_COMPARED, LEAST_REAL = 200, 100
#: Markers of a letters page, and openings by which an item rules itself out.
LETTERS_MARKERS = ("LETTERS TO THE EDITOR", "LESERBRIEFE", "Leserbriefe")
SELF_EXCLUSION = r"(?i)^(not applicable|n/a\b|not geopolitical|non-geopolitical|not a geopolitical)"
#: Number words before a noun for newspapers.
NUMBER_WORDS = {"he": ("שני", "שלושה", "ארבעה", "חמישה", "שישה", "שבעה", "שמונה", "תשעה", "עשרה", "שניים"), "en": ("two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"), "de": ("zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun", "zehn")}
SOURCE_NOUNS = {"en": ("newspapers", "papers", "dailies", "outlets"), "de": ("zeitungen", "blätter", "medien"), "he": ("עיתונים", "עיתוני")}
#: Names of fields that leak into a text, least share of a script, claims that can be about the listed sources.
FIELD_NAMES, LEAST_SHARE, MOST_SOURCES = r"\b(?:comparison_text|topic_label|overview)_(?:he|en|de)\b|\brecord_(?:biweekly_topic|overview|topic_comparison)\b", 0.35, 15
#: Kinds of defects, the most telling first, as they are logged.
DEFECTS = {"foreign_chars": "foreign_script_chars", "mixed_script": "mixed_script", "tag_fragment": "tag_fragment", "low_script_ratio": "low_script_ratio"}

#: White space, listed: much faster than the pattern for it that follows Unicode.
_WORD = re.compile(r"\w+")
_BLANKS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def once(array: Column, use: Callable[[Column], Column]) -> Column:
    """use(array) with the array computed once for each row, even if use() looks at it from every member of an array."""
    return F.get(F.transform(F.array(array), use), F.lit(0))


def squeezed(text: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " "))


def normalised(text: Column) -> Column:
    """Folded to lower case (with sharp s as ss) and squeezed: what two extractions of one page agree on."""
    return F.replace(F.lower(squeezed(text)), F.lit("ß"), F.lit("ss"))


def text_hash(text: Column) -> Column:
    """SHA-256 of the normalised text, or '' if it is too short to compare."""
    return once(normalised(text), lambda n: F.when(F.length(n) < LEAST_COMPARED, "").otherwise(F.sha2(n, 256)))


def real_characters(text: Column) -> Column:
    return F.length(squeezed(F.regexp_replace(F.coalesce(text, F.lit("")), r"\(cid:\d+\)", " ")))


def is_unreadable(text: Column) -> Column:
    """Has glyph codes and hardly anything else."""
    return F.coalesce(text.rlike(r"\(cid:\d+\)"), F.lit(False)) & (real_characters(text) < LEAST_REAL)


def is_letters_page(text: Column) -> Column:
    head = F.substring(text, 1, 200)
    return F.coalesce(head.contains(LETTERS_MARKERS[0]) | head.contains(LETTERS_MARKERS[1]) | head.contains(LETTERS_MARKERS[2]), F.lit(False))


def rules_itself_out(summary: Column) -> Column:
    return F.coalesce(F.trim(summary).rlike(SELF_EXCLUSION), F.lit(False))


def gist(text: Column, most: int = 280) -> Column:
    t = F.trim(text)
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit("..."))).otherwise(t)


def first_words(text: Column, n: int = 6) -> Column:
    return F.array_join(F.slice(F.split(squeezed(text), " "), 1, n), " ")


def word_count(text: Column) -> Column:
    return F.when(squeezed(text) == "", 0).otherwise(F.size(F.split(squeezed(text), " "))).cast("long")


def over_ceiling(words: Column, ceiling: int) -> tuple[Column, Column]:
    """Above the ceiling, and above it with a tenth to spare."""
    return words > ceiling, words > int(ceiling * 1.1)


def word_set(text: Column, longer_than: int = 2) -> Column:
    """Sorted distinct lower-case words of more than so many characters."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"(?U)\w{{{longer_than + 1},}}"), F.lit(0))
    return F.array_sort(F.array_distinct(found))


def opening_sentence(text: Column, most: int = 300) -> Column:
    """Up to the first . ! or ? before white space or the end, or else the first characters."""
    flat = F.replace(F.trim(F.coalesce(text, F.lit(""))), F.lit("U.S."), F.lit("US"))
    found = F.regexp_extract(flat, r"(?s)^(.+?[.!?])(\s|$)", 1)
    return F.when(found != "", found).otherwise(F.substring(flat, 1, most))


def is_suspicious(text: Column) -> Column:
    """Shorter than 50 characters, with a piece of a closing tag, or a number only."""
    return text.isNull() | (F.length(text) < 50) | text.rlike(r"</\w+") | F.trim(text).rlike(r"^\d+$")


def foreign_letters(text: Column, allowed: str) -> Column:
    """Sorted distinct letters outside the Java class `allowed`, such as \\p{IsLatin}."""
    rest = F.regexp_replace(F.coalesce(text, F.lit("")), rf"[^\p{{L}}]|{allowed}", "")
    return F.array_sort(F.array_distinct(F.filter(F.split(rest, ""), lambda c: c != "")))


def script_ratio(text: Column, script: str, least: int = 40) -> Column:
    """Letters of a script among all letters; null with fewer than `least` letters."""
    letters = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]+", ""))
    own = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), rf"[^{script}]+", ""))
    return F.when(letters >= least, own / letters)


def mixed_script_words(text: Column, script: str, other: str, but: str | None = None) -> Column:
    """Words that have letters of both scripts, less those that are all of the pattern `but`, such as a prefix before a name."""
    # most texts have letters of one script only, and aren't cut into words
    both = F.coalesce(text.rlike(script) & text.rlike(other), F.lit(False))
    found = F.when(both, F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return F.filter(found, lambda w: w.rlike(script) & w.rlike(other) & (~w.rlike(f"^(?:{but})$") if but else F.lit(True)))


def joined_prefix_repaired(text: Column, prefix: str, other: str, words: Sequence[str] = ()) -> Column:
    """A prefix of another script glued to a word: a hyphen between, or a blank after two letters or more. With `words`, a blank after
    these and a hyphen after any other one or two letters. Repairing twice changes nothing."""
    if words:
        text = F.regexp_replace(text, rf"(?<!\p{{L}})({'|'.join(words)})(?={other})", "$1 ")
        return F.regexp_replace(text, rf"(?<!\p{{L}})({prefix}{{1,2}})(?={other})", "$1-")
    text = F.regexp_replace(text, rf"(?<!\p{{L}})({prefix})(?={other})", "$1-")
    return F.regexp_replace(text, rf"(?<!\p{{L}})({prefix}{{2,}})(?={other})", "$1 ")


def leftover_tags(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"</?\w+>?"), F.lit(0))


def tag_fragments(text: Column) -> Column:
    """Beginnings of tags and names of fields inside a text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"</?[A-Za-z_][\w:-]*|{FIELD_NAMES}"), F.lit(0))


def text_defects(text: Column, allowed: str, scripts: tuple[str, ...], expected: str | None = None) -> Column:
    """Map of the kinds of defects that a text has to what was found: characters outside the Java class `allowed`, words of both `scripts` (and a third pattern of such words that are right), tags and field names, and a share of
    letters of the script `expected` (null: not judged) below LEAST_SHARE. Empty if the text is clean."""
    # a single class can be passed over in runs
    allowed = f"{allowed}+" if re.fullmatch(r"\[[^\[]*\]", allowed) else allowed
    strange = F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), allowed, ""), ""), lambda c: c != "")))
    ratio = script_ratio(text, expected) if expected else F.lit(None).cast("double")
    low = F.when(ratio < LEAST_SHARE, F.array(F.round(ratio, 2).cast("string"))).otherwise(F.array().cast("array<string>"))
    found = dict(zip(DEFECTS, (strange, mixed_script_words(text, *scripts), tag_fragments(text), low), strict=True))
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, found)), F.array(*found.values())), lambda _, v: F.size(v) > 0)


def priority_defect(defects: Column, otherwise: str = "suspicious") -> Column:
    """The most telling kind in a map of text_defects(), by its name in the log."""
    return F.coalesce(*[F.when(F.array_contains(F.map_keys(defects), kind), F.lit(name)) for kind, name in DEFECTS.items()], F.lit(otherwise))


def claims_in(said: str | None, lang: str) -> list[int]:
    """Numbers, as digits or words, that stand before a noun for newspapers, or one word before it. In Hebrew letters may be joined to the number, and the noun follows at once and may go on."""
    words = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(said or "")]
    values = {w: 2 + k % 9 for k, w in enumerate(NUMBER_WORDS[lang])}
    near = lambda i: i < len(words) and said[words[i - 1][2] : words[i][1]].isspace()
    out, i = [], 0
    while i < len(words):
        own = words[i][0]
        if lang == "he":
            word = max((w for w in values if own.endswith(w)), key=len, default="")
            digits = own[len(own.rstrip("0123456789")) :]
            number = values.get(word) if word else int(digits) if digits else None
            if number is not None and near(i + 1) and words[i + 1][0].startswith(SOURCE_NOUNS[lang]):
                out.append(number)
            i += 1
            continue
        number = values.get(own) if own in values else int(own) if own.isdecimal() else None
        # the noun is looked for behind one more word first
        far = next((k for k in (2, 1) if number is not None and all(near(i + j + 1) for j in range(k)) and words[i + k][0] in SOURCE_NOUNS[lang]), 0)
        if far:
            out.append(number)
        i += far + 1
    return out


def claimed_sources(text: Column, lang: str) -> Column:
    """Numbers of newspapers that a text claims (see claims_in())."""
    return one_by_one(lambda t: claims_in(t, lang) if t and any(n in t.lower() for n in SOURCE_NOUNS[lang]) else [], "array<int>", pa.list_(pa.int32()))(text)


def tells(text: Column, dictionary: Sequence[str]) -> Column:
    """Which entries of a dictionary a text has, after typographic quotes are made plain."""
    plain = F.translate(F.coalesce(text, F.lit("")), "’‘“”", "''\"\"")
    return F.filter(F.array(*map(F.lit, dictionary)), lambda t: plain.contains(t))


def one_for_and(text: Column) -> Column:
    """A digit 1 wedged between two names by a hyphen: what stands left and right of each 1 is looked at, once there are a hyphen and a 1 side by side."""
    sides = F.split(F.coalesce(text, F.lit("")), "1")
    pair = lambda i: (F.get(sides, i), F.get(sides, i + 1))

    def wedged(i: Column) -> Column:
        left, right = pair(i)
        hyphen_left = F.right(left, F.lit(1)) == "-"
        before, after = F.substring(left, -2, 1), F.substring(right, 2, 1)
        blank = F.when(hyphen_left, F.substring(right, 1, 1)).otherwise(F.right(left, F.lit(1)))
        hyphen = hyphen_left | (F.substring(right, 1, 1) == "-")
        return hyphen & before.between("a", "z") & (F.length(before) == 1) & blank.isin(" ", "\u00a0") & after.between("A", "Z") & (F.length(after) == 1)

    some = F.exists(F.sequence(F.lit(0), F.size(sides) - 2), wedged)
    return F.coalesce(F.when(text.contains("-1") | text.contains("1-"), some), F.lit(False))


def content_key(*parts: Column) -> Column:
    """Sixteen hex digits for a list of parts, null and empty told apart."""
    return F.substring(F.sha2(F.to_json(F.array(*parts)), 256), 1, 16)


def html_escaped(text: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def without_dates(name: Column) -> Column:
    """A file name with dates and numbers taken out, for grouping issues of one title."""
    name = F.regexp_replace(F.lower(name), r"\.[a-z0-9]{2,4}$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"\d+", " "), r"[\s_\-.,]+", " "))
