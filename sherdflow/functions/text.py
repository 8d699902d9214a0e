"""Column expressions for identifiers, notes, captions and paragraphs.

All positions are code points from 0. Normalisation for matching is one character for one character, so a span found
in normalised text cuts the same span from the original.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that are read as others, and the grammar's patterns.
COLONS = "∶："
TILDES = "～〜"
PARENS = "（）"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
ARTIFACT = r"[A-Za-z0-9][A-Za-z0-9.\-]*:\d+(?:-\d+)?"
COMPONENT = r"(?U)\b[A-Z][a-z]+\d+\b"
HEAD_SEQ = r"\d+(?:\s*~\s*\d+)?(?:\s*[、,]\s*\d+)*|[A-Z]"
HEAD = rf"(?:{HEAD_SEQ})\s*[.、]?"
SCALE_NOISE = r"^[\d\s\-.~]*厘米?$"
GLUED_SEQ = r"^\d+\.(?=[A-Za-z0-9.\-]*[A-Za-z][A-Za-z0-9.\-]*:)"
FIGURE_NUMBER = r"(图|圖)\s*([0-9]+(?:[-.][0-9]+)*|[一二三四五六七八九十百千〇两]+)([a-zA-Z0-9])?"
PLATE_NUMBER = r"(图版|圖版|拓片)\s*([0-9〇O一二三四五六七八九十百千]+)"
PLATE_WORD = "图版|圖版"
LINE_WORD = "拓片|拓本|拓印|线描|摹写"
PIECES = r"\d+\s*件"
FIGURE_REF = r"图\s*[\d一二三四五六七八九十〇]+"


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def aligned(x: Column) -> Column:
    r"""Normalised for matching, every character in its place; \sim becomes a tilde and three spaces."""
    one = F.translate(x, COLONS + TILDES + PARENS + "$" + CIRCLED, "::~~() " + "123456789" + "0" * 11)
    return F.regexp_replace(one, r"\\sim", "~   ")


def normalize(x: Column) -> Column:
    """Normalised for reading: circled numbers become their digits, so later characters move."""
    out = F.regexp_replace(F.translate(x, COLONS + TILDES + PARENS + "$" + CIRCLED[:9], "::~~() 123456789"), r"\\sim", "~  ")
    for n in range(10, 21):
        out = F.replace(out, F.lit(CIRCLED[n - 1]), F.lit(str(n)))
    return out


def colon_norm(x: Column) -> Column:
    return F.translate(x, COLONS, "::")


def path_artifact(x: Column) -> Column:
    return F.translate(x, ":" + COLONS, "---")


def canonical_figure(x: Column) -> Column:
    return F.coalesce(F.translate(x, "Oo 　", "〇〇"), F.lit(""))


def figure_number(caption: Column, fallback: Column | None = None) -> Column:
    part = [F.regexp_extract(F.coalesce(caption, F.lit("")), FIGURE_NUMBER, k) for k in (1, 2, 3)]
    suffix = F.when(part[2].isin("O", "o", "0"), "〇").otherwise(part[2])
    other = F.coalesce(F.when(fallback != "", fallback) if fallback is not None else None or F.lit(None).cast("string"), F.lit("图"))
    return F.when(part[0] != "", F.concat(part[0], part[1], suffix)).otherwise(other)


def plate_number(caption: Column, fallback: Column | None = None) -> Column:
    part = [F.regexp_extract(F.coalesce(caption, F.lit("")), PLATE_NUMBER, k) for k in (1, 2)]
    return F.when(part[0] != "", F.concat(part[0], F.translate(part[1], "O", "〇"))).otherwise(figure_number(caption, fallback))


def image_name(figure: Column, seq: Column, artifact: Column) -> Column:
    return F.concat(F.concat_ws("_", figure, F.coalesce(seq, F.lit("01")), path_artifact(artifact)), F.lit(".png"))


def stem(fileref: Column) -> Column:
    """The file's name without folders and last suffix."""
    return F.regexp_extract(fileref, r"([^/]+?)(?:\.[^./]*)?$", 1)


def event_id(figure_id: Column, alarms: Column, reason: Column) -> Column:
    told = F.concat_ws("|", figure_id, F.array_join(F.array_sort(F.coalesce(alarms, F.array().cast("array<string>"))), ","), F.coalesce(reason, F.lit("")))
    return F.concat(figure_id, F.lit(":"), F.substring(F.sha1(told), 1, 12))


def joined_key(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def line_hint(caption: Column, note: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(note, F.lit(""))).rlike(LINE_WORD)


def trace_id(run: Column, thread_key: Column) -> Column:
    """A UUID's shape from the hash of a run and a thread: the same in each attempt of a task."""
    return F.regexp_replace(F.md5(F.concat_ws("|", run, thread_key)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def plate_hint(caption: Column) -> Column:
    return F.coalesce(caption, F.lit("")).rlike(PLATE_WORD)


def let(value: Column, body) -> Column:
    """body(value), with value computed once for each row however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(x: Column, pattern: str) -> Column:
    """array<struct<start, stop, hit>> of all matches, for a pattern that never matches the empty string.

    The gaps between matches and the matches take turns, so running lengths give the positions.
    """
    hits, gaps = F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), F.split(x, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,hit:string>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        a = acc["at"] + F.char_length(pair["gap"])
        z = a + F.char_length(pair["hit"])
        return F.struct(z.alias("at"), F.concat(acc["out"], F.array(F.struct(a.alias("start"), z.alias("stop"), pair["hit"].alias("hit")))).alias("out"))

    pairs = let(hits, lambda h: F.zip_with(F.slice(gaps, 1, F.size(h)), h, lambda g, x: F.struct(g.alias("gap"), x.alias("hit"))))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def cut(x: Column, start: Column, stop: Column) -> Column:
    return F.substring(x, start + 1, stop - start)


def artifact_spans(norm: Column) -> Column:
    """Spans of artifact ids in aligned text, without a sequence number that is glued to an id's front."""

    def tidy(s: Column) -> Column:
        lead = F.char_length(F.regexp_extract(s["hit"], GLUED_SEQ, 0))
        return F.struct((s["start"] + lead).alias("start"), s["stop"].alias("stop"))

    return F.transform(spans(norm, ARTIFACT), tidy)


def component_spans(norm: Column) -> Column:
    return F.transform(spans(norm, COMPONENT), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))


def caption_artifacts(caption: Column) -> Column:
    """Distinct ids of a caption in their order; components inside another id don't count."""
    text = F.coalesce(caption, F.lit(""))

    def read(norm: Column) -> Column:
        def with_ids(ids: Column) -> Column:
            own = F.filter(component_spans(norm), lambda c: ~F.exists(ids, lambda s: (s["start"] <= c["start"]) & (c["start"] < s["stop"])))
            return F.array_distinct(F.transform(F.array_sort(F.concat(ids, own)), lambda s: colon_norm(cut(text, s["start"], s["stop"]))))

        return let(artifact_spans(norm), with_ids)

    any_id = F.lit(f"{ARTIFACT}|{COMPONENT}")  # most captions name none, which one match tells
    return F.when(F.regexp_like(aligned(text), any_id), let(aligned(text), read)).otherwise(F.array().cast("array<string>"))


def expand_seq(seq: Column) -> Column:
    """`1~3、5` -> [1, 2, 3, 5]; parts that are no numbers and reversed ranges give nothing."""
    parts = F.split(F.translate(seq, "～，、", "~,,"), ",")

    def numbers(part: Column) -> Column:
        a, b = F.regexp_extract(part, r"^\s*(\d+)\s*~\s*(\d+)\s*$", 1), F.regexp_extract(part, r"^\s*(\d+)\s*~\s*(\d+)\s*$", 2)
        one = F.regexp_extract(part, r"^\s*(\d+)\s*$", 1)
        none = F.array().cast("array<int>")
        return (
            F.when((a != "") & (a.try_cast("int") <= b.try_cast("int")), F.sequence(a.try_cast("int"), b.try_cast("int")))
            .when(one != "", F.array(one.try_cast("int")))
            .otherwise(none)
        )

    return F.flatten(F.transform(parts, numbers))


def has_artifact(x: Column) -> Column:
    """Whether raw text shows an artifact or component id (colons as they are)."""
    return F.coalesce(x, F.lit("")).rlike(ARTIFACT) | F.coalesce(x, F.lit("")).rlike(COMPONENT)
