"""Character maps: sectioned text read as records, checked, and cut down to what a text mentions.

A map is lines; a heading holds for the lines after it. It is carried forward by a window over a map's lines that ignores
nulls, so a map becomes rows first and records by grouping them: no map is walked line by line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import BLANK, stripped
from tessera.operators.dictionary import casefold, found_terms

LINE_ENDS = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"

# Labels of a record's lines, and the fields they fill. Of SINGLE fields the last line counts, LISTS gather all.
SINGLE = {
    "giới tính": "gender", "ngôi thứ ba": "pronoun_3rd", "tự xưng": "self_address", "cách gọi người khác": "addressing_others", "gọi người khác": "addressing_others",
    "tuổi/vị thế": "relative_status", "vị thế": "relative_status", "tính cách": "personality", "giọng nói": "speech_style", "giọng thoại": "speech_style", "vai trò": "role",
}
LISTS = {
    "quan hệ": "relationships", "xưng hô theo đối tượng": "addressing_by_target", "xưng hô cấm": "forbidden_pronouns", "danh hiệu/chức vụ": "title_terms",
    "ghi chú": "notes", "tránh": "avoid_notes",
}
ALIASES, TITLE, THIRD_PERSON = "tên khác", "danh hiệu/chức vụ", "ngôi thứ ba"
CHAPTERS = {"lần đầu xuất hiện": "first_seen_chapter", "lần cuối xuất hiện": "last_seen_chapter"}
# Words that tell a map's genre, the first genre that has one counts; genres whose narration avoids some pronouns.
GENRE_WORDS = {
    "korean_cultivation": ["korean cultivation", "tu tiên hàn quốc", "tu tiên hàn", "tu tiên kiểu hàn", "korean murim"],
    "western_fantasy": ["western fantasy", "korean light novel", "fantasy kiểu korean", "trung cổ phương tây", "tên tây", "fantasy phương tây", "knight", "hiệp sĩ"],
    "tien_hiep": ["tiên hiệp", "tu tiên", "xianxia", "luyện khí", "kim đan"],
    "he_thong": ["hệ thống", "system", "litrpg", "[exp]", "[hp]", "exp:"],
    "kiem_hiep": ["kiếm hiệp", "wuxia", "giang hồ", "võ lâm"],
    "do_thi": ["đô thị", "hiện đại", "urban"],
}
PLAIN_GENRES = ["western_fantasy", "do_thi", "lang_man", "korean_cultivation"]
OLD_PRONOUNS = ["hắn", "nàng", "lão", "y"]
PRIORITY_WORDS = ["nhân vật chính", "main character", "priority", "vai trò: chính"]
# Headings about a whole story's voice; headings that are only data about the map.
VOICE_OF_ENTRIES = "Quy tắc văn phong|Giọng văn|Phong cách|Tone|Voice|Narrative"
VOICE, ABOUT = VOICE_OF_ENTRIES + "|Style notes", r"Truyện\s*:|Cập nhật|Updated\s*:|Story\s*ID\s*:"


def lines(maps: DataFrame, key: str, text: str) -> DataFrame:
    """key, n, line, s (stripped): the lines of each map; a null or empty one has none."""
    d = maps.where(F.col(text) != "").select(F.col(key), F.posexplode(F.split(text, LINE_ENDS)).alias("n", "line"))
    return d.withColumn("s", stripped(F.col("line")))


def _carried(key: str, value: Column) -> Column:
    """The last value at or above each line; lines without one have a null."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0))


def _heading(c: Column, s: Column) -> Column:
    """The heading that a line which starts with its marks gives: c is the line as it is compared, s stripped."""
    return F.when(F.startswith(c, F.lit("### ")), stripped(F.substr(s, F.lit(5))))


def _item(s: Column) -> tuple[Column, Column, Column]:
    """Whether a stripped line is an item with a label, what stands before its first colon, and behind."""
    body = F.substr(s, F.lit(3))
    at = F.instr(body, ":")
    return F.startswith(s, F.lit("- ")) & (at > 0), F.substr(body, F.lit(1), at - 1), stripped(F.substr(body, at + 1))


def _split(c: Column, mark: str) -> Column:
    """Stripped parts that aren't empty."""
    return F.filter(F.transform(F.split(c, mark), stripped), lambda x: x != "")


def characters(maps: DataFrame, key: str, text: str) -> DataFrame:
    """key, name_key (lower case), name as first written, and all fields: a row for each character of each map.

    Headings equal but for case are one character. Lines before the first heading, without a label, or of an unknown one are
    left out; a chapter without digits is as if not there.
    """
    out, key = key, "_key"
    d = lines(maps.select(F.col(out).alias(key), F.col(text).alias("_map")), key, "_map")
    d = d.withColumn("name", _heading(F.col("s"), F.col("s")))
    d = d.withColumn("name_key", _carried(key, F.lower("name"))).where("name_key IS NOT NULL")
    item, label, value = _item(F.col("s"))
    label = F.lower(F.regexp_replace(label, rf"\A{BLANK}+", ""))
    d = d.select(key, "n", "name_key", "name", F.when(item, label).alias("label"), value.alias("value"))
    last = lambda labels, v: F.max_by(F.when(F.col("label").isin(*labels), v), F.when(F.col("label").isin(*labels) & v.isNotNull(), F.col("n")))
    of = lambda table: {f: [k for k, v in table.items() if v == f] for f in dict.fromkeys(table.values())}
    v = F.col("value")
    every = lambda labels: F.transform(F.array_sort(F.collect_list(F.when(F.col("label").isin(*labels), F.struct("n", "value")))), lambda x: x["value"])
    number = F.expr("try_cast(nullif(regexp_extract(value, '[0-9]+', 0), '') AS BIGINT)")
    return d.groupBy(key, "name_key").agg(
        F.min_by("name", F.when(F.col("name").isNotNull(), F.col("n"))).alias("name"), _split(last([ALIASES], v), ",").alias("aliases"),
        *(last(labels, v).alias(f) for f, labels in of(SINGLE).items()), *(every(labels).alias(f) for f, labels in of(LISTS).items()),
        *(last(labels, number).alias(f) for f, labels in of(CHAPTERS).items()),
    ).withColumnRenamed(key, out)


def genre(text: Column) -> Column:
    """What a map's words tell of its genre; empty for none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return reduce(lambda rest, g: F.when(has(GENRE_WORDS[g]), g).otherwise(rest), reversed(GENRE_WORDS), F.lit(""))


def aliases(d: DataFrame, key: str) -> DataFrame:
    """key, first (line), wrong (lower case), right of lines() between [ALIASES] and the next bracketed line; of a name that repeats the last line counts."""
    s = F.col("s")
    mark = F.when(F.lower(s) == "[aliases]", True).when(F.startswith(s, F.lit("[")) & F.endswith(s, F.lit("]")), False)
    inside = d.withColumn("mark", mark).withColumn("inside", _carried(key, F.col("mark"))).where("inside AND mark IS NULL")
    at = F.instr(s, "=")
    inside = inside.where((at > 0) & ~F.startswith(s, F.lit("#")))
    return inside.groupBy(key, F.lower(stripped(F.substr(s, F.lit(1), at - 1))).alias("wrong")).agg(F.min("n").alias("first"), F.max_by(stripped(F.substr(s, at + 1)), "n").alias("right"))


def map_issues(maps: DataFrame, key: str, text: str) -> DataFrame:
    """key, issues: warnings of each map as codes, aliases first, then entries, each in their order (Q35).

    alias_target_unknown: no entry or other name is meant; alias_shadows_entry: the wrong name is an entry's; entry_missing_pronoun; and
    entry_pronoun_genre_conflict: a pronoun that the map's genre avoids. A blank map has no issues. Names are compared without case.
    """
    out, key = key, "_key"
    maps, text = maps.select(F.col(out).alias(key), F.col(text).alias("_map")), "_map"
    d = lines(maps, key, text)
    d = d.withColumn("entry", _carried(key, _heading(F.col("line"), F.col("line"))))
    item, label, value = _item(F.col("s"))
    field = F.when(item & ~F.startswith("line", F.lit("### ")), F.lower(stripped(label)))
    e = d.where("entry <> ''").select(key, "n", "entry", field.alias("field"), value.alias("value"))
    last = lambda f: F.coalesce(F.max_by("value", F.when(F.col("field") == f, F.col("n"))), F.lit(""))
    e = e.groupBy(key, "entry").agg(F.min("n").alias("first"), last(THIRD_PERSON).alias("pronoun"), last(ALIASES).alias("others"))
    e = e.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "entry", "pronoun", "others"))).alias("entries"))
    a = aliases(d, key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first", "wrong", "right"))).alias("aliases"))
    m = maps.select(key, genre(F.col(text)).alias("genre")).join(e, key, "left").join(a, key, "left")
    names = F.transform("entries", lambda x: F.lower(x["entry"]))
    others = F.flatten(F.transform("entries", lambda x: F.transform(_split(x["others"], ","), F.lower)))
    m = m.select(key, "genre", "entries", "aliases", F.coalesce(names, F.array()).alias("names"), F.coalesce(F.concat(names, others), F.array()).alias("known"))
    said = lambda code, x: F.concat(F.lit(f"{code}:"), x["wrong"], F.lit(" -> "), x["right"])

    def of_alias(x: Column) -> Column:
        right = F.lower(x["right"])
        shadows = F.array_contains("names", x["wrong"]) & (x["wrong"] != right)
        return F.array(F.when(~F.array_contains("known", right), said("alias_target_unknown", x)), F.when(shadows, said("alias_shadows_entry", x)))

    def of_entry(x: Column) -> Column:
        bad = F.array_sort(F.array_intersect(F.transform(F.split(x["pronoun"], "[,/;]"), lambda w: F.lower(stripped(w))), F.array(*map(F.lit, OLD_PRONOUNS))))
        clash = F.concat(F.lit("entry_pronoun_genre_conflict:"), x["entry"], F.lit(":"), F.array_join(bad, "/"), F.lit(" (genre="), "genre", F.lit(")"))
        missing = F.concat(F.lit("entry_missing_pronoun:"), x["entry"])
        return F.when(x["pronoun"] == "", missing).when(F.col("genre").isin(*PLAIN_GENRES) & (F.size(bad) > 0), clash)

    found = F.concat(F.coalesce(F.flatten(F.transform("aliases", of_alias)), F.array().cast("array<string>")), F.coalesce(F.transform("entries", of_entry), F.array().cast("array<string>")))
    return m.select(F.col(key).alias(out), F.array_compact(found).alias("issues"))


# --- the part of a map that a text needs (Z5) ---


def story_voice(d: DataFrame, key: str) -> DataFrame:
    """key, voice: of lines() the ## rules above the first entry and the voice sections below it; alias blocks (up to a ---) are left out."""
    s = F.col("s")
    mark = F.when(F.lower(s) == "[aliases]", True).when(s == "---", False)
    w = Window.partitionBy(key).orderBy("n")
    d = d.withColumn("mark", mark).withColumn("inside", F.coalesce(_carried(key, F.col("mark")), F.lit(False)))
    ends = (s == "---") & F.coalesce(F.lag("inside").over(w), F.lit(False))
    d = d.withColumn("out", F.col("inside") | ends).where("NOT out")
    entry, rule = F.startswith(s, F.lit("### ")), F.startswith(s, F.lit("## "))
    d = d.withColumn("below", F.coalesce(_carried(key, F.when(entry, True)), F.lit(False)))
    d = d.withColumn("voice", F.coalesce(_carried(key, F.when(entry, False).when(rule & F.col("below"), s.rlike(rf"(?iu)^##\s*({VOICE})"))), F.lit(False)))
    top = ~F.col("below") & rule & ~s.rlike(rf"(?iu)^##\s*({ABOUT})")
    joined = lambda when: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("n", "line")))), lambda x: x["line"]), "\n")
    d = d.groupBy(key).agg(joined(top).alias("top"), joined(F.col("below") & F.col("voice")).alias("more"))
    parts = F.filter(F.array("top", stripped(F.col("more"))), lambda x: x != "")
    return d.select(key, stripped(F.array_join(parts, "\n\n")).alias("voice"))


def entries(d: DataFrame, key: str) -> DataFrame:
    """key, entry (number), text, first (its heading line, folded), priority, surfaces (folded): the entries of lines()."""
    s = F.col("s")
    starts = F.startswith(s, F.lit("### "))
    d = d.withColumn("inside", _carried(key, F.when(s.rlike(rf"(?iu)^##\s*({VOICE_OF_ENTRIES})"), False).when(starts, True))).where("inside")
    d = d.withColumn("entry", F.count_if(starts).over(Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)))
    low = F.lower(s)
    value = stripped(F.substr(s, F.instr(s, ":") + 1))
    surfaces = F.when(starts, F.array(stripped(F.substr(s, F.lit(5))))).when(F.startswith(low, F.lit(f"- {ALIASES}:")), _split(value, ",")).when(F.startswith(low, F.lit(f"- {TITLE}:")), F.array(value))
    e = d.groupBy(key, "entry").agg(
        stripped(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")).alias("text"),
        F.array_join(F.filter(F.flatten(F.collect_list(surfaces)), lambda x: x != ""), "\n").alias("surfaces"),
    )
    e = e.select(key, "entry", "text", casefold("text").alias("folded"), F.split(casefold("surfaces"), "\n").alias("surfaces"))
    priority = reduce(lambda a, b: a | b, [F.contains("folded", F.lit(w)) for w in PRIORITY_WORDS])
    return e.select(key, "entry", "text", F.substring_index("folded", "\n", 1).alias("first"), priority.alias("priority"), F.array_distinct("surfaces").alias("surfaces"))


def relevant(maps: DataFrame, map_key: str, map_text: str, texts: DataFrame, key: str, text: str, *, most: int = 20, fallback: int = 4) -> DataFrame:
    """key, char_map: for every text the voice section and the entries of its map that it needs (Z5). texts has map_key too; its key is unique.

    Needed are entries one of whose names the text holds, then those of priority, each heading once, up to `most` in all; a text
    that needs none gets the map's first `fallback`. A map without entries is given whole, a text whose map is null, empty or missing gets an
    empty one. All names of all maps are sought at once by one automaton.
    """
    out_key = key
    maps = maps.select(F.col(map_key).alias("_story"), F.col(map_text).alias("_map"))
    texts = texts.select(F.col(key).alias("_key"), F.col(map_key).alias("_story"), F.col(text).alias("_text"))
    key, text, map_key, map_text = "_key", "_text", "_story", "_map"
    d = lines(maps, map_key, map_text)
    e = entries(d, map_key)
    names = e.select(map_key, "entry", F.explode("surfaces").alias("term"))
    t = texts.select(key, map_key)
    found = found_terms(texts, key, text, names).select(key, "term")
    chosen = found.join(t, key).join(names, [map_key, "term"]).select(key, map_key, "entry", F.lit(0).alias("class")).distinct()
    forced = t.join(e.where("priority").select(map_key, "entry"), map_key).select(key, map_key, "entry", F.lit(1).alias("class"))
    both = chosen.unionByName(forced).join(e.select(map_key, "entry", "first", F.col("text").alias("body")), [map_key, "entry"])
    once = both.groupBy(key, "first").agg(F.min(F.struct("class", "entry", "body")).alias("e"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("e.class", "e.entry"))
    once = once.withColumn("rank", rank).where(F.col("rank") <= most)
    bodies = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "e.body"))), lambda x: x["body"]), "\n\n")
    needed = once.groupBy(key).agg(bodies.alias("needed"))
    start = e.where(F.col("entry") <= min(fallback, most)).groupBy(map_key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entry", "text"))), lambda x: x["text"]), "\n\n").alias("start"))
    m = maps.select(map_key, F.col(map_text).alias("whole")).join(story_voice(d, map_key), map_key, "left").join(start, map_key, "left")
    out = t.join(needed, key, "left").join(m, map_key, "left")
    parts = F.filter(F.array(F.coalesce("voice", F.lit("")), F.coalesce("needed", "start", F.lit(""))), lambda x: x != "")
    return out.select(F.col(key).alias(out_key), F.when(F.col("start").isNull(), F.coalesce("whole", F.lit(""))).otherwise(stripped(F.array_join(parts, "\n\n---\n\n"))).alias("char_map"))
