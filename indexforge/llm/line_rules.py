"""Quality rules, line first.

Every line of a text is judged alone by three rules: punctuation (no letter or digit at all, or
too many symbols), navigation (menu separators, or nothing but menu words) and boilerplate
(licence, cookie and copyright phrases).  Failing lines are removed; a document that loses more
than ``max_lost_pct`` of its visible characters is rejected, and so is one that fails the base
limits on words and repeated windows.

All of it is one pass of built-in expressions over the row, with no shuffle, so no key and no
group of copies can be hot.  Only a text with a repeated window pays for the sort of its windows.

Defined results: a null text counts as empty; an empty or blank text has no words, fails the
base limits and is not kept; every input row yields one row, repeated rows included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexforge.llm.text import WS, let, ws_words

#: The symbols counted by the base rules, the separators and words of menus,
#: and phrases of notices.
SYMBOLS = "#*$%&|<>"
LINE_SYMBOLS = "#*$%&|<>{}[]\\^~_=+@!?"
MENU_SEPARATORS = ["|", "»", "›", "·", "•", "::", "/", ">"]
MENU_WORDS = ["home", "about", "contact", "login", "logout", "menu", "next", "previous", "search",
              "share", "sitemap", "help", "faq", "register", "subscribe", "top", "back", "more"]
NOTICES = ("(?i)all rights reserved|copyright|licen[sc]ed under|cookie|privacy policy|"
           "terms of (use|service)|click here|enable javascript|subscribe to|lorem ipsum")


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_window_words(words: Column, width: int = 5) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the array."""
    def marked(s: Column) -> Column:
        same = lambda e, j: e["h"] == F.get(s, j)["h"]
        twice = F.transform(s, lambda e, i: F.when(
            F.coalesce(same(e, i - 1), F.lit(False)) | F.coalesce(same(e, i + 1), F.lit(False)), e["p"]))
        starts = F.sort_array(F.filter(twice, lambda p: p.isNotNull()))
        return F.aggregate(
            starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda a, p: F.struct((a["n"] + p + width - F.greatest(p, a["end"])).alias("n"),
                                  (p + width).alias("end")),
            lambda a: a["n"])

    def of_hashes(h: Column) -> Column:
        windows = F.slice(F.transform(h, lambda x, i: F.xxhash64(
            x, *[F.get(h, i + k) for k in range(1, width)])), F.lit(1),
            F.greatest(F.size(h) - (width - 1), F.lit(0)))
        return let(windows, lambda w: F.when(
            F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
                let(F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p")))), marked)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def line_fails(line: Column, max_symbol_pct: int = 10) -> Column:
    """The three line rules on one line that has a word."""
    seen = F.length(F.translate(line, WS, ""))
    punctuation = (~line.rlike("[\\p{L}\\p{N}]")) | (
        _count(line, LINE_SYMBOLS) * 100 > seen * max_symbol_pct)
    parts = F.split(F.lower(F.trim(line, F.lit(WS))), "[ \\x09-\\x0D]+")
    bars = F.size(F.filter(parts, lambda w: w.isin(MENU_SEPARATORS)))
    navigation = ((bars >= 3) & (bars * 4 >= F.size(parts))) | (
        F.size(F.filter(parts, lambda w: ~w.isin(MENU_WORDS + MENU_SEPARATORS))) == 0)
    return punctuation | navigation | line.rlike(NOTICES)


def clean_lines(text: Column, max_symbol_pct: int = 10) -> Column:
    """The text without its failing lines; blank lines stay."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: (F.trim(x, F.lit(WS)) == "")
                                 | ~line_fails(x, max_symbol_pct)), "\n")


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", *,
                  min_words: int = 10, max_repeat_pct: int = 20, max_symbol_pct: int = 10,
                  max_lost_pct: int = 50) -> DataFrame:
    """One row per row of ``docs``: key, the base counts, ``clean_text`` and the verdicts.

    Only ``key`` and ``text`` are read; other columns of ``docs`` cannot clash with the result.
    """
    d = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(WS)) != "")
    d = d.select("*", let(ws_words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_window_words(w).alias("n_repeat_words"))).alias("w"),
        F.length(F.translate("text", WS, "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        clean_lines(F.col("text"), max_symbol_pct).alias("clean_text"))
    left = F.length(F.translate("clean_text", WS, "")).cast("long")
    failed = (F.col("w.n_words") < min_words) | (
        100 * F.col("w.n_repeat_words") > max_repeat_pct * F.col("w.n_words"))
    lost = 100 * (F.col("word_chars") - left) > max_lost_pct * F.col("word_chars")
    return d.select(F.col("key").alias(key), F.col("w.n_words").alias("n_words"), "word_chars",
                    "n_symbols", "n_dup_lines", F.col("w.n_repeat_words").alias("n_repeat_words"),
                    failed.alias("base_failed"), (~failed & ~lost).alias("kept"),
                    left.alias("left_chars"), "clean_text")
