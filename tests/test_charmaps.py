"""Character maps against walks over their lines, and the automaton against regular expressions."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import charmaps as C
from tessera.operators import dictionary as D

GOOD = """## Thể loại: Tu tiên Hàn Quốc (korean cultivation)

[ALIASES]
Eun-hyun = Seo Eun-Hyun

### Seo Eun-Hyun
- Tên khác: Deputy Manager Seo
- Ngôi thứ ba: anh ta
- Tự xưng: tôi
"""
BAD = """## Thể loại: Tu tiên Hàn Quốc (korean cultivation)

[ALIASES]
Eun-hyun = Seo Eun-Hyun
Ai Đó = Người Không Tồn Tại
Kim Yeon = Kim Young-hoon

### Seo Eun-Hyun
- Ngôi thứ ba: hắn
- Tự xưng: ta

### Kim Yeon
- Ngôi thứ ba: cô ta

### Nhân Vật Thiếu Pronoun
- Tự xưng: tôi

### Kim Young-hoon
- Ngôi thứ ba: anh ta
"""
PLAIN = "## Thể loại: tiên hiệp\n\n### Lý Mộ Trần\n- Ngôi thứ ba: hắn\n"


def maps(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, map string")


def test_issues_of_maps(spark):
    got = {r.id: r.issues for r in C.map_issues(maps(spark, GOOD, "", BAD, PLAIN, None, " \n "), "id", "map").collect()}
    assert got == {
        0: [], 1: [], 3: [], 4: [], 5: [],
        2: ["alias_target_unknown:ai đó -> Người Không Tồn Tại", "alias_shadows_entry:kim yeon -> Kim Young-hoon",
            "entry_pronoun_genre_conflict:Seo Eun-Hyun:hắn (genre=korean_cultivation)", "entry_missing_pronoun:Nhân Vật Thiếu Pronoun"],
    }


PARTS = [
    "### A", "### a ", "### Bê", " ### Bê", "###", "### ", "## Tone: dry", "## Truyện: x", "## Rule one", "[ALIASES]", "[other]", "---", "x = A", "X=Bê ", "# c = d", "a = nobody", "- Tên khác: A1, a2 ,,", "-Tên khác: no",
    "- Ngôi thứ ba: hắn/anh", "- ngôi thứ ba : nàng", "- Ngôi thứ ba:", "- Quan hệ: bạn: của A", "- Quan hệ: thù", "- Tuổi/Vị thế: cao", "- vị thế: thấp", "- Vai trò: chính", "- Danh hiệu/chức vụ: Vua", "- Lần đầu xuất hiện: chương 12, 13",
    "- Lần đầu xuất hiện: chưa rõ", "- Lần cuối xuất hiện: 40", "plain text", "", "  - Tự xưng: ta ", "- Ghi chú: một", "- không có nhãn", "hiện đại", "Narrative", "## narrative voice", "- Main Character: yes",
]


def random_maps(n, seed=6):
    rng = random.Random(seed)
    return [rng.choice(["\n", "\n", "\r\n"]).join(rng.choice(PARTS) for _ in range(rng.randint(0, 22))) for _ in range(n)]


def walk_characters(text):
    out, now = {}, None
    for line in (text or "").splitlines():
        s = line.strip()
        if s.startswith("### "):
            name = s[4:].strip()
            now = out.setdefault(name.lower(), {"name": name, "lists": {}, "aliases": None})
        elif now and s.startswith("- ") and ":" in s:
            label, value = (x.strip() if i else x.lstrip() for i, x in enumerate(s[2:].split(":", 1)))
            label = label.lower()
            if label in C.LISTS:
                now["lists"].setdefault(C.LISTS[label], []).append(value)
            elif label in C.SINGLE:
                now[C.SINGLE[label]] = value
            elif label == C.ALIASES:
                now["aliases"] = [x.strip() for x in value.split(",") if x.strip()]
            elif label in C.CHAPTERS and (m := re.search("[0-9]+", value)):
                now[C.CHAPTERS[label]] = int(m[0])
    return out


def test_characters(spark):
    texts = [*random_maps(300), None, ""]
    got = {(r.id, r.name_key): r for r in C.characters(maps(spark, *texts), "id", "map").collect()}
    want = {(i, k): v for i, t in enumerate(texts) for k, v in walk_characters(t).items()}
    assert got.keys() == want.keys() and len(want) > 150
    for k, w in want.items():
        r = got[k]
        assert (r.name, r.aliases) == (w["name"], w["aliases"])
        assert all(r[f] == w["lists"].get(f, []) for f in C.LISTS.values())
        assert all(r[f] == w.get(f) for f in {*C.SINGLE.values(), *C.CHAPTERS.values()})


def walk_issues(text):
    issues, entries, aliases, now, inside = [], {}, {}, "", False
    for line in (text or "").splitlines():
        s = line.strip()
        if line.startswith("### "):
            now = line[4:].strip()
            if now:
                entries.setdefault(now, {})
        elif now and s.startswith("- ") and ":" in s:
            label, value = s[2:].split(":", 1)
            entries[now][label.strip().lower()] = value.strip()
        if s.lower() == "[aliases]":
            inside = True
        elif s[:1] == "[" and s[-1:] == "]":
            inside = False
        elif inside and "=" in s and s[0] != "#":
            wrong, right = s.split("=", 1)
            aliases[wrong.strip().lower()] = right.strip()
    names = {n.lower() for n in entries}
    known = names | {x.strip().lower() for e in entries.values() for x in e.get(C.ALIASES, "").split(",") if x.strip()}
    for wrong, right in aliases.items():
        issues += [f"alias_target_unknown:{wrong} -> {right}"] * (right.lower() not in known)
        issues += [f"alias_shadows_entry:{wrong} -> {right}"] * (wrong in names and wrong != right.lower())
    genre = next((g for g, ws in C.GENRE_WORDS.items() if any(w in (text or "").lower() for w in ws)), "")
    for name, e in entries.items():
        pronoun = e.get(C.THIRD_PERSON, "")
        bad = sorted({w.strip().lower() for w in re.split("[,/;]", pronoun)} & set(C.OLD_PRONOUNS))
        if not pronoun:
            issues.append(f"entry_missing_pronoun:{name}")
        elif genre in C.PLAIN_GENRES and bad:
            issues.append(f"entry_pronoun_genre_conflict:{name}:{'/'.join(bad)} (genre={genre})")
    return issues


def test_issues_of_random_maps(spark):
    texts = random_maps(200, seed=11)
    got = {r.id: r.issues for r in C.map_issues(maps(spark, *texts), "id", "map").collect()}
    assert got == {i: walk_issues(t) for i, t in enumerate(texts)}
    assert len({x.split(":")[0] for v in got.values() for x in v}) == 4


def walk_relevant(text, body, most, fallback):
    if not text:
        return ""
    voice_top, voice, entries, inside, below, multi, block = [], [], [], False, False, False, False
    for line in text.splitlines():
        s = line.strip()
        if re.match(rf"##\s*({C.VOICE_OF_ENTRIES})", s, re.I):
            block = False
        elif s.startswith("### ") or block:
            if s.startswith("### "):
                entries.append([])
                block = True
            entries[-1].append(line)
        if s.lower() == "[aliases]":
            inside = True
        elif inside:
            inside = s != "---"
        elif s.startswith("### "):
            below, multi = True, False
        elif not below:
            if s.startswith("## ") and not re.match(rf"##\s*({C.ABOUT})", s, re.I):
                voice_top.append(line)
        else:
            if s.startswith("## "):
                multi = bool(re.match(rf"##\s*({C.VOICE})", s, re.I))
            if multi:
                voice.append(line)
    entries = ["\n".join(e).strip() for e in entries]
    if not entries:
        return text
    chosen = []
    for want in (0, 1):
        for e in entries:
            names = [e.splitlines()[0][4:].strip()]
            for s in map(str.strip, e.splitlines()):
                if s.lower().startswith(f"- {C.ALIASES}:"):
                    names += [x.strip() for x in s.split(":", 1)[1].split(",")]
                if s.lower().startswith(f"- {C.TITLE}:"):
                    names.append(s.split(":", 1)[1].strip())
            hit = any(n and n.casefold() in (body or "").casefold() for n in names)
            forced = any(w in e.casefold() for w in C.PRIORITY_WORDS)
            if (forced if want else hit) and e.splitlines()[0].casefold() not in {c.splitlines()[0].casefold() for c in chosen}:
                chosen.append(e)
    chosen = chosen[:most] or entries[: min(fallback, most)]
    head = "\n\n".join(x for x in ("\n".join(voice_top), "\n".join(voice).strip()) if x).strip()
    return "\n\n---\n\n".join(x for x in (head, "\n\n".join(chosen)) if x.strip()).strip()


@pytest.mark.parametrize(("most", "fallback"), [(20, 4), (2, 4)])
def test_relevant_entries(spark, most, fallback):
    rng = random.Random(3)
    texts = [t.replace("\r\n", "\n") for t in random_maps(80, seed=5)] + [None, "", GOOD, BAD]
    bodies = [(i, rng.randrange(len(texts) + 1), rng.choice([None, "", "BÊ là vua", "không ai", "a1 x", "deputy manager seo", "xin chào VUA"])) for i in range(300)]
    got = C.relevant(maps(spark, *texts), "id", "map", spark.createDataFrame(bodies, "doc long, id long, body string"), "doc", "body", most=most, fallback=fallback)
    got = {r.doc: r.char_map for r in got.collect()}
    assert got == {d: walk_relevant(texts[m] if m < len(texts) else None, b, most, fallback) for d, m, b in bodies}


# --- the automaton ---


def test_terms_equal_regular_expressions(spark):
    rng = random.Random(9)
    letters = "abAB éß_ 1-"
    texts = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(120)] + [(500, None), (501, "")]
    terms = [*{"".join(rng.choice(letters) for _ in range(rng.randint(1, 3))) for _ in range(80)}, "", None]
    t, w = spark.createDataFrame(texts, "id long, x string"), spark.createDataFrame([(x,) for x in terms], "term string")
    for whole in (False, True):
        for block in (1 << 20, 40):
            got = Counter({(r.id, r.term): r.n for r in D.found_terms(t, "id", "x", w, fold=False, whole_words=whole, block=block).collect()})
            want = Counter()
            for i, x in texts:
                for term in filter(None, set(terms)):
                    edge = (r"(?<!\w)" if whole and re.match(r"\w", term) else "", r"(?!\w)" if whole and re.match(r"\w", term[-1]) else "")
                    n = len(re.findall(f"(?={edge[0]}{re.escape(term)}{edge[1]})", x or ""))
                    if n:
                        want[i, term] = n
            assert got == want
    folded = {(r.id, r.term) for r in D.found_terms(t, "id", "x", w).collect()}
    assert folded == {(i, term.casefold()) for i, x in texts for term in filter(None, terms) if term.casefold() in (x or "").casefold()}
    assert D.found_terms(t, "id", "x", w.where("false")).collect() == []


def test_terms_cost_one_scan(spark):
    """A hundred thousand terms take about as long as a hundred, as texts are read once."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(100_000)]
    text = " ".join(rng.choice(words) for _ in range(40_000))
    took = {}
    for n in (100, 100_000):
        found = D.automaton(words[:n], f"speed{n}")
        began = time.perf_counter()
        D.occurrences(text, found, False)
        took[n] = time.perf_counter() - began
    assert took[100_000] < 20 * took[100] + 1
    d = spark.createDataFrame([(1, text)], "id long, x string")
    assert D.found_terms(d, "id", "x", spark.createDataFrame([(x,) for x in words], "term string")).agg(F.sum("n")).first()[0] == len(text.split())


def test_terms_as_sql_counts_them(spark, tmp_path):
    """ß and ss differ, each letter has its own lower case, and occurrences don't overlap."""
    import duckdb

    from tessera.plans import ORACLE_SQL, QUERIES

    terms = ["Schließ die Tür", "SCHLIESS DIE TÜR", "a a a b", "ΟΔΟΣ x ΑΣ", "İI k l", "ǅ ﬁ ŉ", None, "  x", "x\n y z w"]
    texts = ["schließ die tür, schliess die tür, SCHLIEẞ DIE TÜR", "a a a a a a a A A", "οδος x ας ΟΔΟΣ X ΑΣ", "İi K L, i̇I k l", "ǆ ﬁ ŉ", "", None, "   X  x", "X\n Y Z"]
    spark.createDataFrame(list(enumerate(terms)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([*enumerate(texts), (1, texts[1])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    for name in ("benchmark", "documents"):
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = c.sql(ORACLE_SQL["j17_terms_by_automaton"]).fetchall()
    assert Counter(map(tuple, QUERIES["j17_terms_by_automaton"](spark, str(tmp_path)).select("doc_id", "term", "n").collect())) == Counter(want)
    assert (0, "schließ die tür", 2) in want and (1, "a a a", 3) in want and (3, "i̇i k l", 1) not in want


def test_lower_case_of_every_letter():
    import duckdb

    rows = duckdb.sql("SELECT chr(i::INTEGER), lower(chr(i::INTEGER)) FROM range(1, 1114112) r(i) WHERE i NOT BETWEEN 55296 AND 57343").fetchall()
    assert [x for x, low in rows if D.lowered(x) != low] == []
