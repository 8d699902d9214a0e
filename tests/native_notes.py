"""The grammar of notes as nested column expressions: slow, and a second form to compare the reader with."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sherdflow.functions import text as T


def note_items(note: Column) -> Column:
    """array<ITEM>: an entry for each sequence head that leads to a name or to ids.

    A head that begins inside an id is none. Ids belong to the head before them, if they lie wholly before the next.
    """
    raw = F.coalesce(note, F.lit(""))

    def inside(s: Column, at: Column) -> Column:
        return (s["start"] <= at) & (at < s["stop"])

    def read(norm: Column) -> Column:
        ids = F.array_sort(F.concat(T.artifact_spans(norm), T.component_spans(norm)))
        return T.let(ids, lambda i: T.let(F.filter(T.spans(norm, T.HEAD), lambda h: ~F.exists(i, lambda s: inside(s, h["start"]))), lambda h: items(norm, i, h)))

    def items(norm: Column, ids: Column, heads: Column) -> Column:
        def segment(head: Column, i: Column) -> Column:
            end = F.coalesce(F.get(heads, i + 1)["start"], F.char_length(norm))
            mine = F.filter(ids, lambda s: (s["start"] >= head["stop"]) & (s["stop"] <= end))
            arts = F.transform(mine, lambda s: T.colon_norm(T.cut(raw, s["start"], s["stop"])))
            seq = T.strip(F.regexp_extract(T.normalize(T.cut(raw, head["start"], head["stop"])), f"^({T.HEAD_SEQ})", 1))
            name = F.regexp_extract(T.strip(T.cut(raw, head["stop"], end)), r"^([^（(]*)", 1)
            name = F.regexp_replace(T.strip(name), r"^[ .、]+|[ .、]+$", "")
            noise = T.strip(T.cut(norm, head["stop"], end)).rlike(T.SCALE_NOISE)
            return F.struct(seq.alias("seq"), name.alias("name"), arts.alias("artifact_ids"), noise.alias("noise"))

        return F.transform(heads, segment)

    def final(x: Column) -> Column:
        name = F.when((x["name"] != "") & ~F.array_contains(x["artifact_ids"], x["name"]), x["name"])
        return F.struct(x["seq"].alias("seq"), T.expand_seq(x["seq"]).alias("seq_list"), name.alias("name"), x["artifact_ids"].alias("artifact_ids"))

    wanted = F.filter(T.let(T.aligned(raw), read), lambda x: ~(x["noise"] & (F.size(x["artifact_ids"]) == 0)))
    return F.filter(F.transform(wanted, final), lambda x: x["name"].isNotNull() | (F.size(x["artifact_ids"]) > 0))
