"""Operator 7: quality rules, line-first cleaning; DataFrame functions only.

Every line of a text is judged first. A line with a word fails if it is
- symbols: characters of ``#*$%&|<>`` make up more than ``symbol_share`` of its characters;
- navigation: ``|``-like separators between most of its words, or only a few words and a menu word;
- shouting: at least three words, most of whose letters are capitals;
- boilerplate: it holds a stock phrase (licences, cookies, scripts, rights);
- punctuation: it ends without closing punctuation and has fewer words than ``short_line``.
Failing lines are removed; the document is rejected if that loses more than ``max_loss`` of its word characters, or
if the whole-text base rule failed (too few words, too many repeated three-word windows).

Words are runs of characters other than space and \\t\\n\\v\\f\\r. Defined results: NULL text has no words (all counts 0,
base_failed, not kept), like an empty one; lines without a word are never counted or removed as failures; ties do
not arise; repeated rows are judged alike, row by row; other columns are not read, so clashing names do no harm; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# fixed values: white space of the word pattern, symbol characters
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class RuleConfig:
    min_words: int = 50
    repeat_share: int = 50         # per cent of the words inside repeated three-word windows
    symbol_share: float = 0.1
    short_line: int = 6
    capital_share: float = 0.5
    max_loss: float = 0.5
    stops: str = ".!?…:;\"'”’»)"
    #: a line can only match ``boilerplate`` if its text has one of these, in lower case
    phrases: tuple = ("rights reserved", "licensed", "terms of", "privacy policy", "cookie", "javascript",
                      "click here", "subscribe", "copyright", "lorem ipsum", "without warranty")
    boilerplate: str = (r"(?i)\b(all rights reserved|licensed under|this work is licensed|terms of (use|service)|"
                        r"privacy policy|cookies?\b.{0,40}\b(use|accept|policy)|enable javascript|click here|"
                        r"subscribe (now|to)|copyright \(c\)|lorem ipsum|without warranty)")
    menu: str = r"(?i)\b(home|menu|login|log in|sign in|sign up|next|previous|sitemap|contact us|read more)\b"


def words_col(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, f"[{SPACES}]+"), "")


def length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def let(value: Column, f) -> Column:
    """``f`` of ``value``, which is computed once (a column inside a lambda is computed for every element)."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more (first ones included).

    The sorted window hashes show which occur twice; the places of those are merged. With many such hashes the
    places are sorted along with the hashes instead of being looked up.
    """
    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
            F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def twice(s):
        return F.array_distinct(F.filter(s, lambda x, j: x == F.get(s, j + 1)))

    def looked_up(h, few):
        return F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.array_contains(few, F.get(h, i)))

    def sorted_along(h):
        def marked(p):
            return F.filter(p, lambda x, j: (F.get(p, j + 1)["h"] == x["h"])
                            | ((j > 0) & (F.get(p, j - 1)["h"] == x["h"])))

        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.sort_array(F.transform(let(F.sort_array(pairs), marked), lambda x: x["i"]))

    zero = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"))

    def merged(at):
        return F.aggregate(
            at, zero,
            lambda s, i: F.struct((s["n"] + i + 2 - F.greatest(s["end"], i - 1)).alias("n"), (i + 2).alias("end")),
            lambda s: s["n"])

    def count(h):
        return let(let(F.sort_array(h), twice), lambda few: F.when(F.size(few) == 0, F.lit(0)).when(
            F.size(few) <= 64, merged(looked_up(h, few))).otherwise(merged(sorted_along(h))))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes(w), count)))


def line_fails(line: Column, stock: Column, cfg: RuleConfig) -> Column:
    """Whether a line with a word breaks a line rule; ``stock``: the text holds a stock phrase somewhere.

    The cheap tests come first, so a line of prose is judged by its symbols, bars, capitals and last character.
    """
    symbols = F.regexp_count(line, F.lit(f"[{SYMBOLS}]"))
    bars = F.regexp_count(line, F.lit("[|›»·•]"))
    words = F.size(words_col(line))
    ended = F.instr(F.lit(cfg.stops), F.substring(F.rtrim(F.translate(line, SPACES[1:], "     ")), -1, 1))
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    capitals = F.regexp_count(line, F.lit(r"\p{Lu}"))
    return (((ended == 0) & ((words < cfg.short_line) | ((words <= cfg.short_line) & line.rlike(cfg.menu))))
            | (line.rlike(f"[{SYMBOLS}]") & (symbols > cfg.symbol_share * F.length(line)))
            | (line.rlike("[|›»·•]") & (bars >= 2) & (bars * 3 >= words))
            | (line.rlike(r"\p{Lu}{2}") & (words >= 3) & (capitals > cfg.capital_share * letters))
            | (stock & line.rlike(cfg.boilerplate)))


def judge(docs: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Counts, the base rule and the verdict of every document; ``cleaned`` is the text without failing lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long"), text.alias("_t"))
    lines = F.split(F.col("_t"), "\n")
    with_word = F.filter(lines, lambda x: x.rlike(f"[^{SPACES}]"))
    low = F.lower("_t")
    stock = F.lit(False)
    for phrase in cfg.phrases:
        stock = stock | low.contains(phrase)
    d = d.select("*", words_col(F.col("_t")).alias("_w"), with_word.alias("_l"), stock.alias("_stock"))
    d = d.select(
        "doc_id", "_l", "_stock",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"))
    base = (F.col("n_words") < cfg.min_words) | (
        100 * F.col("n_repeat_words") > cfg.repeat_share * F.col("n_words"))

    def judged(failing: bool) -> Column:
        def of(c):
            return F.filter(c["l"], lambda x: line_fails(x, c["stock"], cfg) == F.lit(failing))

        return let(F.struct(F.col("_l").alias("l"), F.col("_stock").alias("stock")), of)

    d = d.withColumn("base_failed", base).withColumn("_lost", judged(True))
    left = F.col("word_chars") - F.aggregate("_lost", F.lit(0), lambda s, x: s + length_without(x, SPACES))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (left >= (1 - cfg.max_loss) * F.col("word_chars"))).alias("kept"),
        F.size("_lost").cast("long").alias("n_failed_lines"),
        F.array_join(judged(False), "\n").alias("cleaned"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("cleaned")
