"""Fill-in-the-middle documents by marker injection, in string functions alone.

A delimiter that a text can hold is escaped first; then ``regexp_replace`` appends it after every line, so that
its count is the number of lines and ``substring_index`` cuts the text at any of them. Parts are unescaped
and put together. Nothing is shuffled: a row is its own text and its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The unit of a cut, and the words of the output that name its parts.
UNIT, PREFIX, SUFFIX, MIDDLE = r"([^\n]*\n|[^\n]+)", "<P>", "<S>", "<M>"
#: The delimiter that is injected, and the character that escapes it and itself.
MARK, ESCAPE = "\x01", "\x02"


def escaped(text: Column) -> Column:
    """The text without the delimiter; the escape character is always followed by what it stands for."""
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "b")), F.lit(MARK), F.lit(ESCAPE + "a"))


def unescaped(text: Column) -> Column:
    """A part as it was, its delimiters dropped."""
    bare = F.replace(text, F.lit(MARK), F.lit(""))
    return F.replace(F.replace(bare, F.lit(ESCAPE + "a"), F.lit(MARK)), F.lit(ESCAPE + "b"), F.lit(ESCAPE))


def before(text: Column, mark: str, n: Column | int) -> Column:
    """What stands before the ``n``-th mark; below zero, after the ``-n``-th from the end."""
    return F.call_function("substring_index", text, F.lit(mark), n if isinstance(n, Column) else F.lit(n))


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers of 32 bits, drawn from an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text of an output; no part holds one of the words that name parts, so each is found by its first place."""
    last, rest = before(output, MIDDLE, -1), before(output, MIDDLE, 1)
    psm = F.concat(before(before(rest, SUFFIX, 1), PREFIX, -1), last, before(rest, SUFFIX, -1))
    spm = F.concat(before(rest, PREFIX, -1), last, before(before(rest, PREFIX, 1), SUFFIX, -1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """One row per document: (id, n, form, prefix, middle, suffix, output), cut at two lines drawn from its id.

    ``n`` counts lines. Of a hundred documents about ``rate`` are transformed, ``spm_rate`` of a hundred of them with the suffix
    first. A null text counts as empty; empty texts and those that hold a part's word stay plain, and their parts are null. A null id
    draws as an empty one. Repeated rows give equal rows; other columns are ignored; an empty table gives an empty one.
    """
    h1, h2, h3, h4 = draws(id_col, seed)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), h1.alias("_1"), h2.alias("_2"), h3.alias("_3"), h4.alias("_4"))
    rows = rows.withColumn("_marked", F.regexp_replace(escaped(F.col("_text")), UNIT, "$1" + MARK))
    rows = rows.withColumn("n", (F.length("_marked") - F.length(F.replace(F.col("_marked"), F.lit(MARK), F.lit("")))).cast("long"))
    rows = rows.withColumns({"_low": F.least(F.col("_1") % (F.col("n") + 1), F.col("_2") % (F.col("n") + 1)).cast("int"), "_high": F.greatest(F.col("_1") % (F.col("n") + 1), F.col("_2") % (F.col("n") + 1)).cast("int")})
    text, n = F.col("_text"), F.col("n").cast("int")
    plain = (text == "") | text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE) | (F.col("_3") % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("_4") % 100 < spm_rate, "spm").otherwise("psm"))
    # Without the last mark, the marks part the lines: ranked parts are what stands before or after the n-th.
    lines, cut = F.col("_lines"), F.col("form") != "plain"
    rows = rows.withColumn("_lines", F.when(cut, before(F.col("_marked"), MARK, n)))
    rows = rows.withColumn("_head", before(lines, MARK, F.col("_high")))
    parts = {
        "prefix": before(F.col("_head"), MARK, F.col("_low")),
        "middle": before(F.col("_head"), MARK, F.col("_low") - F.col("_high")),
        "suffix": before(lines, MARK, F.col("_high") - n),
    }
    rows = rows.withColumns({name: F.when(cut, unescaped(part)) for name, part in parts.items()})
    psm = F.concat(F.lit(PREFIX), F.col("prefix"), F.lit(SUFFIX), F.col("suffix"), F.lit(MIDDLE), F.col("middle"))
    spm = F.concat(F.lit(SUFFIX), F.col("suffix"), F.lit(PREFIX), F.col("prefix"), F.lit(MIDDLE), F.col("middle"))
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(text)
    return rows.select(F.col("_id").alias(id_col), "n", "form", "prefix", "middle", "suffix", output.alias("output"))
