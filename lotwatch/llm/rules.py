"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Function words of the languages that the corpus is read in.
STOP_WORDS = (
    "the", "be", "is", "was", "are", "to", "of", "and", "that", "this", "have", "with", "for", "in", "it", "on", "as", "by",
    "der", "die", "das", "und", "ist", "ein", "eine", "nicht", "zu", "den", "mit", "von", "auf", "sich", "des", "dem",
    "le", "la", "les", "de", "du", "et", "est", "un", "une", "que", "qui", "dans", "pour", "sur", "pas", "par",
    "el", "los", "las", "del", "y", "es", "una", "en", "por", "con", "para", "no", "se", "al", "lo", "como")


@dataclass(frozen=True)
class Rule:
    """``value``, an SQL expression over the statistics, has to lie in [least, most]."""

    name: str
    value: str
    least: float | None = None
    most: float | None = None
    base: bool = False


#: Statistics of one text, as SQL over ``t`` (the text), ``w`` (its words) and ``l`` (its lines
#: that hold a word). ``n_repeat_words`` stands apart below.
STATISTICS = {
    "n_words": "size(w)",
    "word_chars": "length(array_join(w, ''))",
    "n_symbols": "regexp_count(t, '[#*$%&|<>]')",
    "n_lines": "size(l)",
    "n_dup_lines": "size(l) - size(array_distinct(l))",
    "n_bullet_lines": "size(filter(l, x -> substr(ltrim(x), 1, 1) in ('-', '*', '•')))",
    "n_ellipsis_lines": "size(filter(l, x -> endswith(rtrim(x), '...') or endswith(rtrim(x), '…')))",
    "n_stop_words": "size(filter(w, x -> x in (STOP)))",
    "n_letter_words": r"regexp_count(t, '\\p{L}\\S*+')",
    "n_capitals": r"regexp_count(t, '\\p{Lu}')",
}

NAMES = re.compile(r"\b({})\b".format("|".join([*STATISTICS, "n_repeat_words"])))
#: Words ``[^\x20\x09-\x0D]+`` and lines that hold one; cutting at single spaces is the cheapest.
WORDS = ("array_remove(split(replace(replace(replace(replace(replace("
         r"t, '\t', ' '), '\n', ' '), '\u000B', ' '), '\u000C', ' '), '\r', ' '), ' ', -1), '')")
LINES = r"filter(split(t, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')"

#: Words covered by three-word windows at the sorted places ``d``: each adds those that the
#: place before didn't cover.
COVERED = """aggregate(d, struct(-3 as last, 0L as n),
  (acc, p) -> struct(p as last, acc.n + least(3, p - acc.last) as n), acc -> acc.n)"""

#: Places of windows that occur again, from windows sorted as they are.
BY_WINDOW = """transform(array(sort_array(slice(
    transform(w, (x, i) -> struct(x as a, get(w, i + 1) as b, get(w, i + 2) as c, i as p)), 1, size(w) - 2))), s ->
  sort_array(flatten(transform(
    filter(sequence(1, size(s) - 1), i -> s[i].a = s[i - 1].a and s[i].b = s[i - 1].b and s[i].c = s[i - 1].c),
    i -> array(s[i - 1].p, s[i].p)))))[0]"""

#: The same from ``v``: 40 bits of each window's hash over 24 of its place, sorted as numbers,
#: which is several times faster. Should two windows share the bits and not the words, or
#: should a place not fit, windows are sorted after all.
BY_HASH = f"""transform(array(filter(sequence(1, size(v) - 1), i -> shiftright(v[i], 24) = shiftright(v[i - 1], 24))), j ->
  if(size(w) < 16777216 and forall(j, i ->
      w[cast(v[i] & 16777215 as int)] = w[cast(v[i - 1] & 16777215 as int)]
      and w[cast(v[i] & 16777215 as int) + 1] = w[cast(v[i - 1] & 16777215 as int) + 1]
      and w[cast(v[i] & 16777215 as int) + 2] = w[cast(v[i - 1] & 16777215 as int) + 2]),
    sort_array(flatten(transform(j, i -> array(cast(v[i - 1] & 16777215 as int), cast(v[i] & 16777215 as int))))),
    {BY_WINDOW}))[0]"""

#: Words of three-word windows that occur again; where no two hashes are equal, there are none.
REPEATED = f"""transform(array(slice(
    transform(w, (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2))), 1, greatest(size(w) - 2, 0))), h ->
  if(size(array_distinct(h)) = size(h), 0L,
    transform(array(sort_array(transform(h, (x, i) -> (x & -16777216) | i))), v ->
      transform(array({BY_HASH}), d -> {COVERED})[0])[0]))[0]"""

#: The table of thresholds. Ratios are products, so an empty text divides by nothing.
RULES = (
    Rule("few_words", "n_words", least=50, base=True),
    Rule("repeated_words", "100 * n_repeat_words - 50 * n_words", most=0, base=True),
    Rule("many_words", "n_words", most=100_000),
    Rule("short_words", "word_chars - 3 * n_words", least=0),
    Rule("long_words", "word_chars - 12 * n_words", most=0),
    Rule("symbols", "10 * n_symbols - n_words", most=0),
    Rule("few_letter_words", "10 * n_letter_words - 8 * n_words", least=0),
    Rule("few_stop_words", "n_stop_words", least=2),
    Rule("low_stop_word_share", "100 * n_stop_words - 2 * n_words", least=0),
    Rule("repeated_lines", "10 * n_dup_lines - 3 * n_lines", most=0),
    Rule("bullet_lines", "10 * n_bullet_lines - 9 * n_lines", most=0),
    Rule("ellipsis_lines", "10 * n_ellipsis_lines - 3 * n_lines", most=0),
    Rule("capitals", "10 * n_capitals - 3 * word_chars", most=0),
)


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``value`` computed once under a name."""
    return f"transform(array({value}), {name} -> {body})[0]"


def failures(rules: tuple[Rule, ...]) -> str:
    """SQL of the names of the rules that the statistics in ``s`` break."""
    def broken(r: Rule) -> str:
        value = NAMES.sub(r"s.\1", r.value)
        sides = [f"({value}) < {r.least}"] if r.least is not None else []
        sides += [f"({value}) > {r.most}"] if r.most is not None else []
        return " or ".join(sides) or "false"

    cases = ", ".join(f"if({broken(r)}, '{r.name}', null)" for r in rules)
    return f"array_compact(cast(array({cases}) as array<string>))"


def verdict(text: str = "text", rules: tuple[Rule, ...] = RULES) -> Column:
    """The statistics of a text with ``base`` and ``rest``, the names of the rules that it breaks.

    All of it is one expression of built-in functions, in which words, lines and statistics are
    each computed once; no row is shuffled.
    """
    stop = ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)
    counts = [f"cast({sql.replace('STOP', stop)} as long) as {name}" for name, sql in STATISTICS.items()]
    counts.append(f"{REPEATED} as n_repeat_words")
    names = ", ".join(f"s.{n} as {n}" for n in [*STATISTICS, "n_repeat_words"])
    out = let("s", f"struct({', '.join(counts)})", f"struct({names}, {failures(tuple(r for r in rules if r.base))} as base, "
              f"{failures(tuple(r for r in rules if not r.base))} as rest)")
    column = "`{}`".format(text.replace("`", "``"))
    return F.expr(let("t", f"coalesce({column}, '')", let("w", WORDS, let("l", LINES, out))))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, every statistic, ``failed`` (names of broken rules, in table order, base rules
    first), ``base_failed`` and ``kept``, one row per input row; other columns are ignored.

    Null and empty texts have zeros and break the rules that ask for words. Repeated rows are
    judged alike, an empty table gives an empty one. Whole texts are judged; a text's work grows
    with n log n of its words, and one text is in memory at a time.
    """
    rows = docs.select(docs[key].alias("key"), verdict(text, rules).alias("v"))
    return rows.select(
        F.col("key").alias(key), *[F.col(f"v.{n}").alias(n) for n in [*STATISTICS, "n_repeat_words"]],
        F.concat("v.base", "v.rest").alias("failed"), (F.size("v.base") > 0).alias("base_failed"),
        (F.size("v.base") + F.size("v.rest") == 0).alias("kept"))


def keep_passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text breaks no rule, with all their columns and no others.
    Null and empty texts go if a rule asks for words; repeated rows stay repeated."""
    broken = F.transform(F.array(verdict(text, rules)), lambda v: F.size(v["base"]) + F.size(v["rest"]))
    return docs.where(F.get(broken, F.lit(0)) == 0)
