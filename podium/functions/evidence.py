"""How well a text supports a founding year, by where names, words of beginning and years stand.

All of it is positions in one folded text: names are a column, and no pattern is built from data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.names import institution_name

#: Words that open an institution, words for its parts, and the scores of the classes.
TRIGGERS = ("founded", "established", "chartered", "opened", "founding", "establishment", "came into existence")
PARTS = "academy association band branch building campus center centre chair clinic college company department faculty hall hospital initiative institute journal lab laboratory library museum office program programme project school society team unit".split()
NORMALISED, STRUCTURED, NAMED, GENERAL = 140, 110, 80, 55
#: Characters before the year in which a word of beginning counts, and before that word in which the subject stands.
BEFORE_YEAR, BEFORE_TRIGGER = 220, 150
#: Characters after a name in which "came into existence", and after that in which its year counts.
AFTER_NAME, AFTER_EXISTENCE = 80, 80
SHORTEST_NAME = 8

_PART = rf"\b(?:{'|'.join(PARTS)})\b"
_SELF = r"\b(?:our|the|this) (?:institution|university)\b"


def last_place(text: Column, sought: Column) -> Column:
    """Where ``sought`` stands last in ``text``, from 0; -1 if it does not."""
    at = F.instr(F.reverse(text), F.reverse(sought))
    return F.when(at > 0, F.length(text) - at + 1 - F.length(sought)).otherwise(-1)


def befores(text: Column, sought: Column) -> Column:
    """For each place of ``sought`` (no two overlap) the text before it; the text has no control characters."""
    parts = F.split(F.replace(text, sought, F.lit("\u0001")), "\u0001", -1)
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.call_function("array_join", F.slice(parts, F.lit(1), k), sought))).otherwise(F.array())


def _from(text: Column, start: Column) -> Column:
    return F.substring(text, start + 1, F.length(text))


def _subject(before: Column) -> Column:
    """What stands before the last word of beginning near a year; null without such a word."""
    context = F.concat(F.lit(" "), F.right(before, F.lit(BEFORE_YEAR)))
    at = F.greatest(*(last_place(context, F.lit(f" {word} ")) for word in TRIGGERS))
    return F.when(at >= 0, F.right(F.substring(context, F.lit(1), at), F.lit(BEFORE_TRIGGER)))


def _speaks_of(subject: Column, name: Column) -> Column:
    """The subject is the name and no part of what bears it."""
    at = last_place(subject, name)
    rest = F.concat(F.substring(subject, F.lit(1), at), F.lit(" "), _from(subject, at + F.length(name)))
    return (at >= 0) & ~rest.rlike(_PART)


def searched_names(names: Column) -> Column:
    """Names (an array) as they are looked for: folded to words, of at least eight characters."""
    return F.array_distinct(F.filter(names, lambda n: F.length(n) >= SHORTEST_NAME))


def founding_score(text: Column, year: Column, names: Column, method: Column) -> Column:
    """0 to 140: how well an observation of a founding year is supported.

    ``text`` and ``names`` (array) are folded (``names.institution_name``), ``year`` is its digits, ``method``
    how it was found: normalised evidence has 140, structured data 110.  Else the text counts: 80 where, of
    some place of the year, the last word of beginning within 220 characters before has in the 150
    characters before it a name and no word for a part; 55 where it has "our university" or the like and no such
    word; else 0, as without a text, a year or a word of beginning.
    """
    subjects = F.filter(F.transform(befores(text, year), _subject), lambda s: s.isNotNull())

    def one(subject: Column) -> Column:
        general = subject.rlike(_SELF) & ~subject.rlike(_PART)
        return F.when(F.exists(searched_names(names), lambda n: _speaks_of(subject, n)), NAMED).when(general, GENERAL).otherwise(0)

    best = F.coalesce(F.array_max(F.transform(subjects, one)), F.lit(0))
    return F.when(method == "normalised", NORMALISED).when(method == "structured", STRUCTURED).otherwise(best)


def existence_years(text: Column, name: Column) -> Column:
    """Years (digits, distinct) that follow "came into existence" within 80 characters, itself within 80 of the name and
    no word for a part between."""
    pattern = rf"^(.{{0,{AFTER_NAME}}}?)\bcame into existence\b.{{0,{AFTER_EXISTENCE}}}?\b(1[0-9]{{3}}|20[0-9]{{2}})\b"
    starts = F.transform(befores(text, name), lambda b: F.left(_from(text, F.length(b) + F.length(name)), F.lit(AFTER_NAME + AFTER_EXISTENCE + 20)))
    whole = F.filter(starts, lambda s: s.rlike(pattern) & ~F.regexp_extract(s, pattern, 1).rlike(_PART))
    return F.array_distinct(F.transform(whole, lambda s: F.regexp_extract(s, pattern, 2)))


def existence_year(text: Column, names: Column) -> Column:
    """The one year at which a text lets any of the names begin; null if it names none or several."""
    years = F.array_distinct(F.flatten(F.transform(searched_names(names), lambda n: existence_years(text, n))))
    return F.when(F.size(years) == 1, F.get(years, F.lit(0)).cast("int"))

