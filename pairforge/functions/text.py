"""Query text, prompts and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts, tokens and patterns that results must carry exactly.
INSTRUCTION_PREFIX = "Represent the given "
INSTRUCTION_SUFFIX = " product description for image retrieval task."
IMAGE_TOKEN = "<|image_1|>"
IMAGE_TAG_PATTERN = r"<\|image_(\d+)\|>"
URL_PATTERN = (
    r"^(?:http|ftp)s?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+(?:[A-Z]{2,6}\.?|[A-Z0-9-]{2,}\.?)|"
    r"localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?"
    r"(?:/?|[/?]\S+)$"
)
# Every character that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def rstrip(c) -> Column:
    return F.rtrim(_col(c), F.lit(WHITESPACE))


def instruction_text(category) -> Column:
    return F.concat(F.lit(INSTRUCTION_PREFIX), F.lower(_col(category)), F.lit(INSTRUCTION_SUFFIX))


def full_query_text(instruction, query) -> Column:
    """Instruction and query joined by a space, absent parts read as empty, outer whitespace removed."""
    empty = F.lit("")
    return strip(
        F.concat(F.coalesce(_col(instruction), empty), F.lit(" "), F.coalesce(_col(query), empty))
    )


def prompt(instruction, text=None, add_image_token: bool = False, add_video_token: bool = False) -> Column:
    """``[image token + ' '] instruction [' ' + text]``; an empty text adds nothing."""
    if add_video_token:
        raise ValueError("the prompt format has no video token")
    out = _col(instruction)
    if text is not None:
        t = _col(text)
        out = F.when(F.length(t) > 0, F.concat(out, F.lit(" "), t)).otherwise(out)
    return F.concat(F.lit(IMAGE_TOKEN + " "), out) if add_image_token else out


def target_prompt(image_status) -> Column:
    """The target side is its image tag, or empty when there is no usable image."""
    return F.when(_col(image_status) == "ok", F.lit(IMAGE_TOKEN)).otherwise(F.lit(""))


def is_url(c) -> Column:
    return F.coalesce(_col(c).rlike("(?i)" + URL_PATTERN), F.lit(False))


def is_remote(c) -> Column:
    """Paths that would have to be downloaded."""
    return F.coalesce(_col(c).startswith("http://") | _col(c).startswith("https://"), F.lit(False))


def normalize_path(c, base_dir: str = "/") -> Column:
    """Remote and ``/dbfs/`` paths unchanged, all others absolute with ``.`` and ``..`` resolved."""
    path = _col(c)
    absolute = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.lit(base_dir.rstrip("/") + "/"), path)
    )
    steps = F.filter(F.split(absolute, "/"), lambda s: (s != "") & (s != "."))
    resolved = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, s: F.when(
            s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        ).otherwise(F.concat(done, F.array(s))),
    )
    plain = F.when(path.contains("./") | path.contains("//") | path.rlike(r"(^|/)\.{0,2}$"),
                   F.concat(F.lit("/"), F.array_join(resolved, "/"))).otherwise(absolute)
    return F.when(is_remote(path) | path.startswith("/dbfs/"), path).otherwise(plain)


def path_kind(c) -> Column:
    path = _col(c)
    return (
        F.when(path.isNull() | (path == ""), F.lit("empty"))
        .when(is_remote(path), F.lit("remote"))
        .when(path.startswith("/dbfs/"), F.lit("dbfs"))
        .otherwise(F.lit("local"))
    )


def multiple_choice(question, options, answer) -> list[Column]:
    """Question with lettered options, the option list, the lettered answer and its index.

    The last matching option counts; without a match the index is -1, which letters as ``@``.
    """
    q, opts, ans = _col(question), _col(options), _col(answer)
    lettered = F.transform(opts, lambda c, i: F.concat(F.lit("("), F.char(i + 65), F.lit(") "), c))
    hits = F.filter(
        F.transform(opts, lambda c, i: F.when(c == ans, i)), lambda i: i.isNotNull()
    )
    index = F.coalesce(F.array_max(hits), F.lit(-1)).cast("int")
    body = F.concat(q, F.lit("\nOptions:\n"), F.array_join(lettered, "\n"))
    return [
        rstrip(body).alias("question"),
        lettered.alias("options"),
        F.concat(F.lit("("), F.char(index + 65), F.lit(") "), ans).alias("answer"),
        index.alias("answer_index"),
    ]


def image_tag_check(prompt_text, num_images) -> list[Column]:
    """Tags must be exactly 1..m with m the number of images; returns the finding, not an error."""
    tags = F.transform(
        F.regexp_extract_all(_col(prompt_text), F.lit(IMAGE_TAG_PATTERN), F.lit(1)),
        lambda t: t.try_cast("long"),
    )
    distinct = F.array_sort(F.array_distinct(tags))
    m = F.size(distinct)
    expected = F.when(m > 0, F.sequence(F.lit(1).cast("long"), m.cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    consecutive = distinct == expected
    return [
        m.alias("num_tags"),
        consecutive.alias("consecutive"),
        (m == _col(num_images)).alias("count_matches"),
        (consecutive & (m == _col(num_images))).alias("valid"),
    ]
