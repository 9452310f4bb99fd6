"""Small literal cases of the functions and operators."""

from __future__ import annotations

from functools import partial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.functions import values as V
from tessera.operators import batching as B
from tessera.operators import jobs as J
from tessera.operators import metrics as M
from tessera.operators import quality as Q
from tessera.operators import reader, reading
from tessera.operators import relational as R
from tessera.operators import stories


def one(spark, column, **values):
    """The value of a column expression over one row."""
    df = spark.createDataFrame([tuple(values.values())], [*values]) if values else spark.range(1)
    return df.select(column.alias("v")).first().v


def test_rank_tier(spark):
    rows = spark.createDataFrame([(1,), (3,), (4,), (6,), (100,), (None,)], "p int").select(R.rank_tier(F.col("p")).alias("t")).collect()
    tiers = [r.t for r in rows]
    assert tiers[:4] == [0, 0, 1, 1] and tiers[5] > tiers[4]


def test_repair_action(spark):
    cases = {"term_alignment:x": "retranslate", "repeated_content": "repolish", "judge:mistranslation": "retranslate", "judge:unnatural": "repolish"}
    for code, want in cases.items():
        assert one(spark, Q.repair_action(F.array(F.lit(code)))) == want
    assert one(spark, Q.repair_action(F.array().cast("array<string>"))) == "repolish"


def paragraphs(n, word="alpha", same=False):
    return [f"{word} {0 if same else i} " + f"some words that make a long paragraph number {0 if same else i * 7919 % 1000} " * 3 for i in range(n)]


def test_repeated_content(spark):
    a, b = paragraphs(2)
    exact = "\n\n".join([a, b, a.upper()])
    assert one(spark, Q.repeats_exactly(F.lit(exact)))
    assert not one(spark, Q.repeats_exactly(F.lit(f"{a}\n\n{b}")))
    assert not one(spark, Q.repeats_exactly(F.lit("short\n\nshort")))
    near = a.replace("some words", "few words", 1)
    assert one(spark, Q.repeats_nearly(F.lit(f"{a}\n\n{near}")))
    assert not one(spark, Q.repeats_nearly(F.lit("x" * 130 + "\n\n" + "y" * 130)))


def test_completeness(spark):
    codes = lambda text, source: one(spark, Q.completeness(F.lit(text), F.lit(source), F.lit("vi")))
    full = "One sentence of words here. " * 40
    assert codes(full, full) == []
    assert codes("One sentence of words here. " * 10, full)[0].startswith("length_ratio_low:0.25<0.70")
    many, few = "\n\n".join(["a paragraph with some words in it"] * 12), "\n\n".join(["a paragraph with some words in it " * 4] * 3)
    assert "structure_drift:paragraphs:3/12" in codes(few, many)
    said = "\n".join(['"A line that someone says aloud"'] * 12)
    assert "structure_drift:dialogue_lines:2/12" in codes("\n".join(['"A line"'] * 2 + ["x" * 40] * 10), said)
    assert codes("", "short") == []


def test_line_kinds(spark):
    for line, kind in (('"Hello"', "dialogue"), ("— Hello", "dialogue"), ("He went.", "narration"), ("*why?*", "inner_thought"), ("[System] HP +1", "system"), ("", "narration")):
        assert one(spark, Q.line_kind(F.lit(line))) == kind


def test_vietnamese(spark):
    text = "Hắn không biết phải làm gì, nhưng cô ấy đã đến và nói với họ rằng đây là một ngày mới của người trong làng."
    assert one(spark, Q.is_language(F.lit(text), Q.VIETNAMESE))
    assert not one(spark, Q.is_language(F.lit("plain words " * 20), Q.VIETNAMESE))
    assert not one(spark, Q.is_language(F.lit(text + "漢字漢字漢字漢字"), Q.VIETNAMESE))


def test_text_functions(spark):
    assert one(spark, X.slug(F.lit("Tiên Hiệp / A b"))) == "tien-hiep-a-b"
    assert one(spark, X.slug(F.lit("仙侠 小说"))) == "仙侠-小说"
    assert one(spark, X.category_names(F.lit("a, b｜x;a"))) == ["a", "b｜x"]
    assert one(spark, X.comparable(F.lit("A_b, C!d"))) == "a_b c d" and one(spark, X.comparable_no_underscore(F.lit("A_b"))) == "a b"
    assert one(spark, X.chapter_number(F.lit("Chương 0012: x"), F.lit(""), F.lit(3))) == 12
    assert one(spark, X.chapter_number(F.lit("x"), F.lit("http://a/chapter-7"), F.lit(3))) == 7
    assert one(spark, X.digits(F.lit("1,2 a 3"))) == 123 and one(spark, X.digits(F.lit("x"))) == 0
    assert one(spark, X.punctuation_spacing(F.lit('a , b( c ) " d "!e'))) == 'a, b(c) "d"! e'
    assert one(spark, X.unaccented(F.lit("Đường Tăng"))) == "duong tang"
    assert one(spark, X.bounded(F.lit("the void slash."), "Void Slash")) and not one(spark, X.bounded(F.lit("avoid slash"), "void slash"))
    assert one(spark, X.replaced({"lam": "minh", "lam phong": "bac"})(F.lit("lam phong met Lam, lamp"))) == "bac met Minh, lamp"
    assert one(spark, X.without_cjk_spaces(F.lit("漢 字 a b"))) == "漢字a b"
    assert one(spark, X.drop_repeated_paragraphs(F.lit("x" * 130 + "\n\ny\n\ny\n\n" + "X" * 130))) == "x" * 130 + "\n\ny\n\ny"


def test_values(spark):
    assert one(spark, V.hash_sampled("s", F.lit(5), 0)) is False and one(spark, V.hash_sampled("s", F.lit(5), 1)) is True
    assert one(spark, V.srt_time(F.lit(3661.2345))) == "01:01:01,234"
    assert one(spark, V.issue_codes(F.lit('["a", {"code": "b"}, {"x": 1}]')))[:2] == ["a", "b"]
    m = V.json_merge(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), F.lit("3")))
    assert one(spark, m) == {"a": "1", "b": "3"}
    assert one(spark, V.padded(F.array(F.lit(1), F.lit(2)), 4, 0)) == [1, 2, 0, 0]


def test_alignment():
    assert M.alignment("a b c".split(), "a x c d".split()) == (1, 0, 1, 2)
    assert M.alignment([], ["a"]) == (0, 0, 1, 0) and M.alignment(["a"], []) == (0, 1, 0, 0)


def test_word_errors_of_empty_truth(spark):
    r = M.with_errors(spark.createDataFrame([("", "a b")], "t string, h string"), "t", "h").first()
    assert (r.insertions, r.word_num) == (2, 1)


def test_upsert_is_idempotent_and_nulls_never_meet(spark):
    old = spark.createDataFrame([(1, "a", 5), (None, "n", 1)], "k int, name string, top int")
    new = spark.createDataFrame([(1, None, 7), (2, "b", 1), (None, "m", 2)], "k int, name string, top int")
    rules = {"name": J.keep_unless_new, "top": J.greatest}
    once = J.upsert(old, new, ["k"], rules)
    assert sorted(map(tuple, once.collect()), key=str) == sorted([(1, "a", 7), (2, "b", 1), (None, "n", 1), (None, "m", 2)], key=str)
    known = new.where("k IS NOT NULL")
    twice = J.upsert(J.upsert(old, known, ["k"], rules), known, ["k"], rules)
    assert sorted(map(str, twice.collect())) == sorted(map(str, J.upsert(old, known, ["k"], rules).collect()))


def test_segment_diff_counts_pending_as_reset(spark):
    old = spark.createDataFrame([(0, "h0", "ready"), (1, "h1", "pending"), (2, "h2", "ready"), (3, "h3", "running"), (4, "h4", "ready")], "i int, text_hash string, status string")
    new = spark.createDataFrame([(0, "h0"), (1, "h1"), (2, "x"), (5, "h5")], "i int, text_hash string")
    got = {r.i: r.action for r in J.segment_diff(old, new, ["i"]).collect()}
    assert got == {0: "unchanged", 1: "reset", 2: "reset", 3: "kept", 4: "deleted", 5: "inserted"}


def test_empty_tables(spark):
    e = spark.createDataFrame([], "k int, name string, top int")
    assert J.upsert(e, e, ["k"], {"name": J.overwrite}).count() == 0
    assert R.capped(e, ["k"], [F.col("top")], 1).count() == 0
    assert R.numbered(e, [F.col("k")]).count() == 0


def test_global_row_numbers(spark):
    d = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert [r.rn for r in R.numbered(d, [F.col("x")]).orderBy("x").collect()] == list(range(1, 1001))


def test_groups_are_not_transitive(spark):
    d = spark.createDataFrame([(1, "s1", "long title a", ""), (2, "s2", "long title a", "weak key"), (3, "s3", "other title b", "weak key")], "id int, source string, strong string, weak string")
    got = {(r.weak, r.id) for r in R.duplicate_groups(d, "id", "source", ["strong"], "weak").collect()}
    assert got == {(0, 1), (0, 2), (1, 2), (1, 3)}


def test_a_group_by_a_weak_key_of_the_same_ids_counts_once(spark):
    d = spark.createDataFrame([(k, f"s{k % 2}", "the strong key", "the weak key") for k in range(50)], "id int, source string, strong string, weak string")
    got = R.duplicate_groups(d, "id", "source", ["strong"], "weak").collect()
    assert sorted((r.weak, r.id, r.sources) for r in got) == [(0, k, 2) for k in range(50)]


def test_match_by_the_first_key_and_smallest_row(spark):
    left = spark.createDataFrame([(1, "n", "p"), (2, "x", "p"), (3, "x", "y")], "lid int, a string, b string")
    right = spark.createDataFrame([(k, "n" if k == 7 else "m", "p") for k in range(5, 40)], "rid int, a string, b string")
    got = {r.lid: (r.rid, r.key) for r in R.match_by_any_key(left, right, [("a", "a", "name"), ("b", "b", "place")]).collect()}
    assert got == {1: (7, "name"), 2: (5, "place")}


def in_order(fold, ns, *args):
    """The batch of each sample, in the samples' order."""
    return [b for _, b in sorted(fold(enumerate(ns.tolist()), *args))]


lengths = st.lists(st.integers(0, 60), max_size=60).map(lambda x: np.array(x, np.int64))


@given(lengths, st.integers(1, 60))
@settings(deadline=None)
def test_packing_fold(ns, budget):
    out = in_order(B.pack_fold, ns, budget)
    assert all((b == -1) == (n > budget) for b, n in zip(out, ns, strict=True))
    kept = [b for b in out if b >= 0]
    assert kept == sorted(kept)
    for b in set(kept):
        assert sum(n for x, n in zip(out, ns, strict=True) if x == b) <= budget


@given(lengths, st.integers(1, 200))
@settings(deadline=None)
def test_padded_fold(ns, budget):
    out = in_order(B.padded_fold, ns, budget)
    for b in set(out):
        own = [n for x, n in zip(out, ns, strict=True) if x == b]
        assert len(own) == 1 or max(own) * len(own) <= budget


@given(lengths)
@settings(deadline=None)
def test_length_groups_keep_every_sample(ns):
    out = in_order(B.length_group_fold, ns, 100, 1, 50, 5)
    assert all((b == -1) == (not 1 <= n <= 50) for b, n in zip(out, ns, strict=True))


def test_chunks_may_exceed_by_one_line():
    assert in_order(B.chunk_fold, np.array([5, 5, 5, 5]), 8) == [0, 0, 1, 1]


def test_entities_merge_in_order():
    names = [["A", "a2"], ["b"], ["a2", "B"], ["c"]]
    assert [k for _, k in B.entity_fold(enumerate(names))] == [0, 1, 0, 2]


def test_folded_lanes_in_order(spark):
    d = spark.range(3000).select((F.col("id") % 3).alias("lane"), F.col("id").alias("k"), (F.col("id") % 10 + 1).alias("n")).repartition(5)
    for fold in (partial(B.pack_fold, budget=30), partial(B.length_group_fold, budget=40, low=1, high=10, buckets=3)):
        got = B.folded(d, "lane", "k", "n", fold).collect()
        for lane in range(3):
            rows = [(k, k % 10 + 1) for k in range(lane, 3000, 3)]
            assert sorted((r.k, r.batch) for r in got if r.lane == lane) == sorted(fold(rows))
    assert B.folded(d.limit(0), "lane", "k", "n", partial(B.pack_fold, budget=30)).count() == 0


READER = [
    ("Chương 3 - Đêm dài\n\n***\n\nNgười gác cổng ngủ gật.\n\nNgọn đèn đã tắt.\n\n\"Ai đó?\"\n\nCác thay đổi:\n- Sửa dấu câu.\n", "Chương 3 - Đêm dài", 'Người gác cổng ngủ gật. Ngọn đèn đã tắt.\n\n"Ai đó?"'),
    ("Chapter IV: The Road\n\nRain fell .\n\nNobody spoke.", None, "Rain fell. Nobody spoke."),
    ("Chapter 5: It began. The king rode out at dawn.", None, "The king rode out at dawn."),
    ("Lời dẫn.\n\nLưu ý:\n\nBức thư còn nguyên.\n\nNhận xét: đã mượt hơn.", None, "Lời dẫn. Lưu ý: Bức thư còn nguyên."),
    ("Ting!\n\n“Đi thôi”, cô nói.\n”", None, 'Ting!\n\n"Đi thôi", cô nói."'),
    ("Chương Lan cười.\n\nTrời sáng.", None, "Chương Lan cười. Trời sáng."),
    (None, None, ""),
    ("", "x", ""),
]


def test_reader_text(spark):
    rows = [(k, c, t) for k, (c, t, _) in enumerate(READER)] + [(100 + k, w, t) for k, (_, t, w) in enumerate(READER)]
    rows += [(200, " ".join(f"This is sentence {k} of a rather long paragraph." for k in range(40)), None), (201, "Short line here.\n\n" * 3000, None)]
    got = {r.k: r.text for r in reader.reader_text(spark.createDataFrame(rows, "k int, c string, t string"), "k", "c", "t").collect()}
    for k, (_, _, want) in enumerate(READER):
        assert got[k] == want
        # a name whose first letter is a Roman numeral reads as a chapter's number once other text follows in its line
        assert got[100 + k] == ("Trời sáng." if want.startswith("Chương Lan") else want)
    for k in (200, 201):
        parts = got[k].split("\n\n")
        assert len(parts) > 2 and all(400 < len(p) <= reader.LONGEST for p in parts[:-1]) and " ".join(parts).split() == rows[-2 if k == 200 else -1][1].split()


def test_parts_that_fit(spark):
    text = "x" * 300 + ". " + "y" * 100 + "! " + "z" * 600 + "? end"
    rows = spark.createDataFrame([("short one. two",), (text,), ("",), ("." * 600,)], "x string")
    assert [r.parts for r in reader.short_parts(rows, "x").collect()] == [["short one. two"], ["x" * 300 + ". " + "y" * 100 + "!", "z" * 600 + "?", "end"], [""], ["." * 600]]


SPACED = [
    ("a , b .c", "a, b. c"), ("( a ) [b ]", "(a) [b]"), ('say " hi " now', 'say "hi" now'), ("x  y\t\tz", "x y z"), ("3.5", "3. 5"), ("wait...what ?!", "wait... what?!"), (' " a\'b " ', '" a\'b "'),
    ("。甲 ，乙", "。 甲， 乙"), ("it's ' q ', ok", "it's 'q', ok"), ("", ""), ("  ", ""), ('a"b " c " d', 'a"b "c" d'),
]


def test_punctuation_spacing(spark):
    d = spark.createDataFrame(SPACED, "x string, want string").select("x", "want", X.punctuation_spacing(F.col("x")).alias("got"))
    assert [(r.x, r.got) for r in d.collect()] == SPACED


def test_spoken_text(spark):
    d = spark.createDataFrame([(1, "Có 1.500 quân, 21 ngựa, 105 xe, 1005 cung và 2015000 mũi tên. STR 7 x 1234567890")], "k int, v string")
    assert reading.spoken_numbers(d, "k", "v").first().v == "Có một nghìn năm trăm quân, hai mươi mốt ngựa, một trăm lẻ năm xe, một nghìn lẻ năm cung và hai triệu mười lăm nghìn mũi tên. sức mạnh bảy x 1234567890"
    assert reading.packed_clauses('"Một, hai."\nBa; bốn') == "Một hai. Ba. bốn." and reading.packed_clauses("") == "" == reading.packed_clauses(None)
    assert all(len(c) <= 160 for c in reading.packed_clauses("chữ, " * 300).rstrip(".").split(". "))
    got = one(spark, reading.clauses(F.lit("Đi... về, nhé"), {"…": 700}))
    assert [(x.kind, x.content, x.pause_ms) for x in got] == [("text", "Đi", None), ("pause", "…", 700), ("text", "về", None), ("pause", ",", 200), ("text", "nhé", None)]
    assert one(spark, reading.truncated(F.lit("a" * 30 + ". " + "b" * 30), 45)) == "a" * 30 + ".\n[...]"


def test_stream_equals_batch(spark, tmp_path):
    from tessera.streaming import events as E

    d = spark.range(200).select((F.col("id") % 5).alias("user_id"), F.when(F.col("id") % 3 == 0, "error").otherwise("view").alias("event_type"), F.timestamp_seconds(F.col("id") * 100).alias("ts"), F.col("id").cast("double").alias("value"))
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    next((tmp_path / "in").glob("part-*.parquet")).rename(tmp_path / "events.parquet")
    got = []
    E.run_to_end(E.window_counts(E.stream(spark, str(tmp_path), "events")), lambda part, n: got.extend(map(tuple, part.collect())), str(tmp_path / "state"), "complete")
    assert sorted(got) == sorted(map(tuple, E.window_counts(d).collect())) and sum(r[2] for r in got) == 200


def test_readers(spark, tmp_path):
    from tessera.sources import io as S

    (tmp_path / "l.jsonl").write_text('{"id": "a", "text": "x"}\n\nnot json\n{"id": "b"}\n')
    assert [(r.id, r.text) for r in S.json_lines(spark, str(tmp_path / "l.jsonl")).orderBy("id").collect()] == [("a", "x"), ("b", None)]
    (tmp_path / "m.lst").write_text("a.tar a.jsonl 3 4.5\n")
    assert S.shard_manifest(spark, str(tmp_path / "m.lst")).first() == ("a.tar", "a.jsonl", 3, 4.5)
    (tmp_path / "bad.lst").write_text("a.tar 3\n")
    with pytest.raises(Exception, match="four fields"):
        S.shard_manifest(spark, str(tmp_path / "bad.lst")).collect()
    (tmp_path / "t.txt").write_text("".join(f"line {i}\n" for i in range(1000)))
    spark.dataSource.register(S.LineBlocks)
    assert spark.read.format("line_blocks").option("path", str(tmp_path / "t.txt")).option("block", 777).load().count() == 1000


def test_visible_text(spark):
    from tessera.sources import io as S

    html = "<html><head><title> T </title><script>var x='</p>'</script></head><body><nav><a href='/n'>n</a></nav><p>One &amp; two<br>three</p><a href=\"/x\">l</a></body>"
    assert one(spark, S.visible_text(F.lit(html))) == "T One & two\n\nthree\n\nl"
    assert one(spark, S.links(F.lit(html))) == ["/n", "/x"] and one(spark, S.page_title(F.lit(html))) == "T"


def test_token_tallies(spark):
    rows = [(["a", "b", "c"], ["a", "x", "c", "d"]), (["a"], []), ([], ["d"]), (None, None), (["c", "c"], ["c"])]
    got = {r.token: (r.cor, r["sub"], r["del"], r.ins) for r in M.token_tallies(spark.createDataFrame(rows, "t array<string>, h array<string>"), "t", "h").collect()}
    assert got == {"a": (1, 0, 1, 0), "b": (0, 1, 0, 0), "c": (2, 0, 1, 0), "d": (0, 0, 0, 2)}


@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12))
@settings(deadline=None)
def test_steps_are_a_cheapest_alignment(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    out = M.steps(x, y)
    assert sum(what != "cor" for _, what in out) == row[-1]
    assert [t for t, what in out if what != "ins"] == x and sum(what in ("cor", "sub", "ins") for _, what in out) == len(y)


def test_signals(spark):
    rng = np.random.default_rng(4)
    once = rng.normal(size=3000)
    lag, strength = M.repetition(np.concatenate([once, once, once]), 100.0)
    assert lag == 30.0 and strength > 0.9
    assert M.repetition(rng.normal(size=9000), 100.0)[1] < 0.35 and M.repetition(np.zeros(9000), 100.0) == (0.0, 0.0) == M.repetition(np.zeros(3), 100.0)
    s = one(spark, M.signal_statistics(F.array(*map(F.lit, [0.0, 0.5, -1.0, 0.005]))))
    assert (round(s.rms, 6), s.peak, s.clipped, s.silent) == (0.559023, 1.0, 0.25, 0.5)


def test_error_tokens(spark):
    assert one(spark, reading.error_tokens(F.lit("Hi, <noise>you 漢字x é!a"))) == ["HI,", "YOU", "漢", "字", "X", "É!A"]
    assert one(spark, reading.error_tokens(F.lit("a <unk><noise> B"), ["<UNK>"], True, True)) == ["a", "<unk>", "<noise>", "B"]
    assert one(spark, reading.error_tokens(F.lit(None).cast("string"))) == []


def test_names_and_lists(spark):
    assert one(spark, reading.alias_map(F.lit("# x\n- Bo, B = Bob\nBo = Bobby"))) == {"Bo": "Bobby", "B": "Bob"}
    assert one(spark, reading.first_title(F.lit("x\nChapter 1: A\nTitle: B"), ["Title: (.*)", "Chapter 1: (.*)"])) == "B"
    assert one(spark, reading.without_affixes(F.lit(" By Ann (author)"), ["by "], ["(author)"])) == "Ann"
    assert one(spark, reading.foreign_fragments(F.lit("He met Old King in [Big House] near THE TOWN. Kim Young ran"), ["the", "town"], ["Kim", "Young"])) == ["Old King"]
    x = one(spark, reading.with_pronouns(F.lit('he saw her\n"he said"\n he'), {"he": "they"}))
    assert (x.text, x.replaced) == ('they saw her\n"he said"\n they', 2)
    assert one(spark, stories.numbers_of(F.lit("3, 7-9,x, 8,5-4"))) == [3, 7, 8, 9]
    assert one(spark, stories.string_list(F.lit('{"b": ["x", "x", ""]}'), ["a", "b"])) == ["x"]
    assert [k for _, k in B.uncovered_fold(enumerate([["a", "b"], ["B"], ["c"], [], ["c", "d"]]))] == [1, 0, 1, 0, 0]
