"""Text, number and array functions as Columns; everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes of lexical units, sentence marks and comma marks.
LEXICAL = "A-Za-z0-9㐀-鿿"
UNIT = "[A-Za-z]+|[0-9]+|[㐀-鿿]"
SENTENCE_MARKS = "[。！？!?；;\n]"
COMMA_MARKS = "[，,、：:]"
#: Java's Unicode white space, with the four separators that only other engines count.
SPACE = r"(?U)[\s\x{1c}-\x{1f}]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def let(value: Column, use) -> Column:
    """use(value), with value computed once wherever the optimizer moves the expression."""
    return F.transform(F.array(value), use)[0]


def normalized_text(text: Column) -> Column:
    """Letters, digits and CJK characters only, lower-case."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{LEXICAL}]", ""))


def lexical_units(text: Column) -> Column:
    """One entry for each character of the normalized text."""
    return let(normalized_text(text), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "", -1)))


def timestamp_units(text: Column) -> Column:
    """Words, digit runs and single CJK characters, lower-case."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({UNIT})"), F.lit(1)), lambda u: F.lower(u))


def unit_separators(text: Column) -> Column:
    """What follows each timestamp unit up to the next one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?:{UNIT})([^{LEXICAL}]*)"), F.lit(1))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def trim_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")


def punctuation_kind(separator: Column) -> Column:
    """sentence, comma or null; a sentence mark wins."""
    return F.when(separator.rlike(SENTENCE_MARKS), "sentence").when(separator.rlike(COMMA_MARKS), "comma")


def segment_id(seq: Column) -> Column:
    return F.format_string("S%03d", seq)


def audio_time(seconds: Column) -> Column:
    """[hh:]mm:ss.mmm, half-even to milliseconds, never negative."""
    ms = F.greatest(F.rint(seconds * 1000).cast("long"), F.lit(0))
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")

    def whole(t: Column) -> Column:
        hours = F.floor(t / 3600000).cast("long")
        rest = F.concat(pad(F.floor(t % 3600000 / 60000).cast("long"), 2), F.lit(":"), pad(F.floor(t % 60000 / 1000).cast("long"), 2), F.lit("."), pad(t % 1000, 3))
        return F.when(hours > 0, F.concat(F.when(hours < 100, pad(hours, 2)).otherwise(hours.cast("string")), F.lit(":"), rest)).otherwise(rest)

    return let(ms, whole)


def error_rate(target: Column, recognized: Column) -> Column:
    return F.levenshtein(target, recognized) / F.greatest(F.length(target), F.lit(1))


def array_median(values: Column, default: float = 0.0) -> Column:
    """Exact median: the mean of the middle two of an even number; default if empty."""
    middle = lambda s: (F.get(s, F.floor((F.size(s) - 1) / 2).cast("int")) + F.get(s, F.floor(F.size(s) / 2).cast("int"))) / 2
    return F.when(F.size(values) > 0, let(F.array_sort(values), middle)).otherwise(F.lit(default)).cast("double")


def error_summary(message: Column, model: str = "") -> Column:
    """One line for an operator from an error message; model: the name to show."""
    # The reported texts.
    return (
        F.when(message.contains("os error 1455") | message.contains("页面文件太小"), f"Windows提交内存不足（错误1455：页面文件太小），{model}模型未能载入")
        .when(message.contains("CUDA") & (F.lower(message).contains("out of memory") | message.contains("内存")), "GPU显存不足，模型进程未能完成")
        .otherwise(F.substring(F.split(message, LINE_BREAK)[0], 1, 1000))
    )


def nonzero_or(value: Column, default: float) -> Column:
    """default where value is null or zero."""
    return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)
