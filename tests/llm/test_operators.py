"""Operators against plain Python, and the cases each docstring defines."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from tablekeeper.llm import chat, exact, html, leaks, licences, lines, minhash, packing, passages, quality
from tablekeeper.llm import text as tx

DOCS = "doc_id long, text string, kept boolean, score string, line_no int, spans string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def docs(spark, rows):
    """Documents with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, False, "x", 7, "y") for i, t in rows], DOCS)


def prose(seed: int, n: int) -> list[str]:
    pick = random.Random(seed)
    return [pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(n)]


def sentences(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(" ".join(prose(pick.random(), pick.randrange(4, 14))).capitalize() + "." for _ in range(n))


def got(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- exact -------------------------------------------------------------------------

def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_copies_and_the_index(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, None), (8, ""), (None, "a b"), (None, "only"), (4, "z" * 50_000), (4, "z" * 50_000), (7, " a b")]
    index = exact.DigestIndex.fresh(spark, buckets=4)
    out = sorted(got(exact.deduplicate(docs(spark, rows), index), "doc_id", "keep_id", "group_size", "kept", "text_sha256"), key=str)
    sha = {t: hashlib.sha256(normal(t).encode()).hexdigest() for _, t in rows}
    assert out == sorted([
        (5, 3, 3, False, sha["a  b"]), (3, 3, 3, True, sha["a  b"]), (None, 3, 3, False, sha["a  b"]),
        (9, 8, 2, False, sha[None]), (8, 8, 2, True, sha[None]), (None, None, 1, True, sha["only"]),
        (4, 4, 2, True, sha["z" * 50_000]), (4, 4, 2, True, sha["z" * 50_000]), (7, 7, 1, True, sha[" a b"]),
    ], key=str)
    again = got(exact.deduplicate(docs(spark, [(1, "a b"), (2, "new"), (1, "new")]), index), "doc_id", "keep_id", "kept")
    assert sorted(again) == [(1, 1, True), (1, 3, False), (2, 1, False)]
    assert index.read().count() == 6
    assert got(exact.deduplicate(docs(spark, []), index), "doc_id") == []
    index_again = [got(exact.deduplicate(docs(spark, [(6, "fresh"), (6, "a b")]), index, batch="b"), "doc_id", "keep_id", "kept") for _ in range(2)]
    assert sorted(index_again[0]) == sorted(index_again[1]) == [(6, 3, False), (6, 6, True)]
    plan = index.read().join(index.read().withColumnRenamed("keep_id", "k"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan


def test_near_duplicates_refuse_what_the_bands_miss(spark):
    with pytest.raises(ValueError, match="80"):
        minhash.near_duplicates(docs(spark, []), percent=50)


def test_kept_ids_come_from_the_index(spark):
    """The first batch too is held against the (empty) index, and takes its ids from it by a merge join."""
    index = exact.DigestIndex.fresh(spark, buckets=4)
    seen, save = [], index._save

    def watched(rows):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        save(rows)

    index._save = watched
    exact.deduplicate(docs(spark, [(1, "a"), (2, "a")]), index)
    assert "Join LeftAnti" in seen[-1]
    spark.sql(f"INSERT INTO {index.name} SELECT sha2('other', 256), -5L, 'x'")
    found = got(exact.deduplicate(docs(spark, [(1, "other"), (2, "a")]), index), "doc_id", "keep_id", "kept")
    assert sorted(found) == [(1, -5, False), (2, 1, False)]


# --- benchmark ----------------------------------------------------------------------

def brute_leaks(texts, items, window=10):
    wins = {}
    for item, text in items:
        words = leaks.item_words(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            wins.setdefault(tuple(words[k : k + window]), set()).add(item)
    out = []
    for text in texts:
        words, hit, found = leaks.item_words(text), set(), set()
        for n in {len(w) for w in wins}:
            for k in range(len(words) - n + 1):
                owners = wins.get(tuple(words[k : k + n]))
                if owners is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in owners if x is not None}
        out.append((len(words), len(hit), sorted(found)))
    return out


def leak_case():
    few = WORDS[:5]  # so few words that phrases meet by chance and overlap
    pick = random.Random(3)
    items = [(k, " ".join(pick.choices(few, k=pick.choice([3, 6, 12, 14])))) for k in range(40)]
    items += [(50, None), (51, "--"), (None, "omicron pi rho"), (52, "ÉTÉ Tau"), (0, "xi nu xi nu xi nu xi nu xi nu xi nu")]
    texts = [" ".join(pick.choices([*few, "xi", "nu"], k=pick.randrange(0, 300))) for _ in range(60)]
    texts += [None, "", "...", "Omicron, PI; rho!", "ÉTÉ tau", "été tau", "xi nu " * 3_000, items[2][1], items[2][1].upper() + " x"]
    return items, texts


@pytest.mark.parametrize("block", [leaks.BLOCK_CHARS, 200])
def test_leaks_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(leaks, "BLOCK_CHARS", block)
    items, texts = leak_case()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = leaks.find_benchmark(docs(spark, list(enumerate(texts))), bench).orderBy("doc_id")
    assert [(n, h, list(i)) for n, h, i in got(found, "n_words", "n_hit", "item_ids")] == brute_leaks(texts, items)
    cleaned = leaks.remove_benchmark(docs(spark, list(enumerate(texts))), bench)
    assert cleaned.columns == docs(spark, []).columns
    left = [t for (t,) in got(cleaned.orderBy("doc_id"), "text")]
    assert all(h == 0 for _, h, _ in brute_leaks(left, items)) and left[60] is None
    before = brute_leaks(texts, items)
    assert all(a == b for a, b, (_, h, _) in zip(texts, left, before, strict=True) if not h)
    none = spark.createDataFrame([], bench.schema)
    assert got(leaks.find_benchmark(docs(spark, [(1, "a b")]), none), "n_hit") == [(0,)]
    assert got(leaks.find_benchmark(docs(spark, []), bench), "n_hit") == []


def test_fm_index_finds_every_place():
    pick = np.random.default_rng(1)
    text = pick.integers(1, 4, 400)
    text[[99, 250, 399]] = 0
    index = leaks.FMIndex(text, np.array([0, 100, 251]), 3)
    for phrase in itertools.product([1, 2, 3], repeat=3):
        low, high = index.search(np.array([phrase]))
        want = [k for k in range(398) if tuple(text[k : k + 3]) == phrase]
        assert sorted(index.locate(np.arange(low[0], high[0]))) == want


# --- near copies ---------------------------------------------------------------------

def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", leaks_lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def leaks_lower(text):
    return (text or "").translate(leaks._LOWER)


def brute_components(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    low = list(range(len(rows)))

    def root(k):
        while low[k] != k:
            k = low[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(rows):
        mine = [rows[x][0] for x in range(len(rows)) if root(x) == root(k)]
        smallest = min(mine) if i is not None and sets[k] else i
        out.append((i, len(sets[k]), smallest, i == smallest))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, width):
    pick = random.Random(width)
    rows = []
    for family in range(12):
        base = prose(family, pick.choice([1, 3, 40, 120]))
        for _ in range(12):
            words = list(base)
            for _ in range(pick.randrange(0, 1 + len(words) // 8)):
                words[pick.randrange(len(words))] = "new" + str(pick.randrange(1_000))
            rows.append((len(rows) + 10, pick.choice([" ", "\n", "  "]).join(words)))
    rows += [(500, None), (501, ""), (502, " \t"), (None, rows[0][1]), (None, "free"), (rows[5][0], rows[5][1]), (3, rows[5][1].upper())]
    rows += [(600, " ".join(prose(77, 30_000))), (601, " ".join(prose(77, 30_000)[1:]))]
    found = got(minhash.near_duplicates(docs(spark, rows), width), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(found, key=str) == sorted(brute_components(rows, width), key=str)
    assert got(minhash.near_duplicates(docs(spark, []), width), "doc_id") == []


def test_loosely_similar_group(spark):
    """Copies that are linked only among some of them, in one bucket group."""
    pick, base, rows = random.Random(8), prose(1, 60), []
    for k in range(150):
        words = list(base)
        for at in pick.sample(range(60), pick.choice([1, 4, 7, 9])):
            words[at] = "w" + str(pick.randrange(10_000))
        rows.append((k, " ".join(words)))
    found = got(minhash.near_duplicates(docs(spark, rows), 2), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(found) == sorted(brute_components(rows, 2))


def test_rarest_shingles_lose_no_pair(spark):
    """Sets of 80 percent in common meet by a shingle of their prefixes, unless they have one label."""
    pick, sets = random.Random(4), []
    for k in range(80):
        own = set(range(40)) - set(pick.sample(range(40), pick.randrange(6)))
        sets.append(sorted(own | {1_000 + pick.randrange(60) for _ in range(pick.randrange(7))}))
    table = spark.createDataFrame([(k, k // 2, s) for k, s in enumerate(sets)], "node long, label long, shingles array<long>")
    posts = minhash._prefixes(table, 80)
    near = {
        (a, b) for a in range(80) for b in range(a + 1, 80)
        if a // 2 != b // 2 and 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})
    }
    met = {(min(r), max(r)) for r in got(minhash._all_across(posts, 80), "a", "b")}
    first = {(min(r), max(r)) for r in got(minhash._foremost(posts, 80), "a", "b")}
    assert near and near <= met and first <= met and len(met) < 80 * 79 // 2 - 40
    assert all(a // 2 != b // 2 for a, b in met)


# --- lines ------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_bound():
    pick = random.Random(5)
    pairs = []
    for _ in range(1_500):
        a = bytes(pick.choices(b"ab ", k=pick.randrange(0, 30)))
        b = bytearray(a)
        for _ in range(pick.randrange(4)):
            at = pick.randrange(len(b) + 1)
            b[at : at + pick.randrange(2)] = bytes(pick.choices(b"ab", k=pick.randrange(2)))
        pairs.append((a, bytes(b)))
    for edits in (1, 2, 3):
        near = lines.within_edits([a for a, _ in pairs], [b for _, b in pairs], edits)
        assert near.tolist() == [distance(a, b) <= edits for a, b in pairs]


def test_lines_match_brute_force(spark):
    pick = random.Random(11)
    pool = [" ".join(prose(k, 5)) for k in range(12)]
    rows = []
    for k in range(30):
        own = []
        for _ in range(pick.randrange(0, 6)):
            line = bytearray(pick.choice(pool).encode())
            for _ in range(pick.randrange(4)):
                line[pick.randrange(len(line))] = pick.choice(b"xyz")
            own.append(pick.choice(["", " "]) + line.decode() + pick.choice(["", "\r"]))
        rows.append((k, "\n".join([*own, "short", "short"])))
    rows += [(100, None), (101, ""), (None, pool[0]), (None, "a line that no other row has"), (4, rows[4][1]), (102, "q" * 60_000 + "\n" + "q" * 59_999)]
    at = [
        ((i is None, i or 0, k), line.strip(" \t\r").encode())
        for i, text in rows for k, line in enumerate((text or "").split("\n")) if line.strip(" \t\r")
    ]
    small = [(p, t) for p, t in at if len(t) < 1_000]
    want = {p for p, t in small if any(q < p and distance(t, u) <= 2 for q, u in small)} | {(False, 102, 1)}
    found = {(i is None, i or 0, k) for i, k in got(lines.duplicate_lines(docs(spark, rows)), "doc_id", "line_no")}
    assert found == want
    cut = lines.remove_lines(docs(spark, rows))
    assert cut.count() == len(rows)
    kept = {r.doc_id: r.text for r in cut.collect() if r.doc_id is not None}
    for i, text in rows:
        if i is not None:
            mine = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (False, i, k) not in want)
            assert kept[i] == mine
    assert got(lines.duplicate_lines(docs(spark, [])), "doc_id") == []


def test_short_lines_and_characters(spark):
    """Short lines are copies of equal ones only, and an edit is one of a character however many bytes it has."""
    accents, chinese = "der größte Käse über allen Bergen", "数据处理系统的设计与实现方法和经验总结报告"
    rows = [
        (1, "Kurz.\n\nab\n" + accents), (2, " Kurz.\t\n \nac\n" + accents.replace("ö", "ø").replace("Ü".lower(), "u")),
        (3, chinese + "\nx\nx"), (4, chinese.replace("系", "糸") + "\nKurz!"), (5, "数据处理\n" + "的".join(chinese)),
        (6, "数据处理\nab"), (7, accents.replace("ö", "o").replace("ä", "a").replace("ü", "u")),
    ]
    listed = [(2, 0), (2, 3), (3, 2), (4, 0), (6, 0), (6, 1), (7, 0)]
    assert distance(accents, rows[6][1]) == 3 and distance(rows[1][1].split("\n")[3], rows[6][1]) == 2
    assert sorted(got(lines.duplicate_lines(docs(spark, rows)), "doc_id", "line_no")) == listed
    left = dict(got(lines.remove_lines(docs(spark, rows)), "doc_id", "text"))
    assert left == {
        i: "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in listed) for i, text in rows
    }
    pick, pairs = random.Random(6), []
    for _ in range(800):
        a = pick.choices("aé中😀", k=pick.randrange(0, 20))
        b = list(a)
        for _ in range(pick.randrange(5)):
            at = pick.randrange(len(b) + 1)
            b[at : at + pick.randrange(2)] = pick.choices("aé中😀", k=pick.randrange(2))
        pairs.append(("".join(a), "".join(b)))
    near = lines.within_edits([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs], 2)
    assert near.tolist() == [distance(a, b) <= 2 for a, b in pairs]


def test_rows_without_id_or_with_one_id_keep_their_own_lines(spark):
    first, second, own = "the very first line of all rows", "another line that stands elsewhere", "a line that no other row has"
    rows = [
        (1, first + "\n" + second), (None, first), (None, own), (None, own + " at all\n" + second), (None, None), (None, ""),
        (7, first + "\nseven alone has this one line"), (7, "only the second row of seven has it\n" + second), (8, own + "\n" + first),
    ]
    cut = lines.remove_lines(docs(spark, rows)).withColumn("text", F.coalesce("text", F.lit("(null)")))
    assert sorted(got(cut, "doc_id", "text", "removed_lines"), key=str) == sorted([
        (1, rows[0][1], 0), (None, "", 1), (None, "", 1), (None, own + " at all", 1), (None, "(null)", 0), (None, "", 0),
        (7, "seven alone has this one line", 1), (7, "only the second row of seven has it", 1), (8, own, 1),
    ], key=str)
    same = got(lines.remove_lines(docs(spark, [(None, own + "\n1"), (None, own + "\n2"), (3, "x")])), "text", "removed_lines")
    assert sorted(n for _, n in same) == [0, 0, 1] and {"1", "2"} & {t for t, _ in same}


def test_keys_of_near_lines_meet():
    """Two lines within two edits share a key, and a deep one, of the shorter as index and the longer as probe."""
    pick = random.Random(12)
    texts, pairs = [], []
    for _ in range(400):
        a = "".join(pick.choices("abcd", k=pick.randrange(20, 60)))
        b = list(a)
        for _ in range(2):
            at = pick.randrange(len(b) + 1)
            b[at : at + pick.randrange(2)] = pick.choices("abcd", k=pick.randrange(2))
        pairs.append(sorted(["".join(b), a], key=len))
    texts = [t.encode() for pair in pairs for t in pair]
    bounds = np.cumsum([0, *map(len, texts)])
    sums = tx.prefix_sums(tx.mix(np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + tx.U64(1)))
    for deep in (False, True):
        index, probes = lines.line_keys(sums, bounds[:-1], bounds[1:], 2, deep)
        assert all(set(index[2 * k]) & set(probes[2 * k + 1]) - {0} for k in range(len(pairs)))
        assert (index != 0).all()


def test_loose_groups_and_clashing_names(spark, monkeypatch):
    """A group whose lines share a segment but are mostly further apart, so that all rounds have work."""
    monkeypatch.setattr(lines, "small_side", lambda df: df)
    pick = random.Random(13)
    head, tail = "the same beginning of many lines ", " and the same end"
    texts = []
    for _ in range(260):
        middle = "".join(pick.choices("abc", k=7))
        texts.append(pick.choice([head, head[:-9]]) + middle + pick.choice([tail, tail + "!", tail[:-2]]))
    rows = [(k, t) for k, t in enumerate(texts)]
    want = [k for k, t in rows if any(abs(len(t) - len(u)) < 3 and distance(t, u) <= 2 for u in texts[:k])]
    assert 30 < len(want) < 230
    assert sorted(k for k, _ in got(lines.duplicate_lines(docs(spark, rows)), "doc_id", "line_no")) == want
    odd = spark.createDataFrame(
        [(k, f"{t}\nown {k}", "a", "b", 3, 4, "c", "d") for k, t in rows],
        "doc_id long, text string, _gone string, _id string, no int, `odd.key` int, gone string, row string",
    )
    cut = {r.doc_id: r for r in lines.remove_lines(odd).collect()}
    assert all(tuple(cut[k])[2:8] == ("a", "b", 3, 4, "c", "d") for k, _ in rows)
    assert all(cut[k].text == (f"own {k}" if k in set(want) else f"{t}\nown {k}") for k, t in rows)
    assert lines.remove_lines(odd.limit(0)).columns == [*odd.columns, "removed_lines"] and not lines.remove_lines(odd.limit(0)).count()


# --- passages ------------------------------------------------------------------------------

def test_passages(spark):
    shared = sentences(1, 9)
    lone = " ".join(prose(2, 60)) + "."
    rows = [
        (1, sentences(10, 6) + "\n" + shared + "\n" + sentences(11, 6)), (2, sentences(12, 5) + "\n" + shared.upper().replace(" ", "  ")),
        (3, shared + "\n" + sentences(13, 4)), (4, lone + " " + sentences(14, 3)), (5, sentences(15, 3) + " " + lone),
        (6, "Short one. Short two."), (7, "Short one. Short two."), (8, None), (9, ""), (3, shared + "\n" + sentences(13, 4)), (None, shared),
    ]
    out = {}
    for i, text, n, gone in got(passages.remove_repeated(docs(spark, rows)), "doc_id", "text", "n_sentences", "n_removed"):
        out.setdefault(i, []).append((text, n, gone))
    assert out[1] == [(rows[0][1], 21, 0)] and out[4] == [(rows[3][1], 4, 0)]
    assert out[2] == [(sentences(12, 5), 14, 9)]
    assert out[3] == [(sentences(13, 4), 13, 9)] * 2
    assert out[5] == [(sentences(15, 3), 4, 1)]
    assert out[6] == out[7] == [("Short one. Short two.", 2, 0)]
    assert out[8] == [(None, 0, 0)] and out[9] == [("", 0, 0)] and out[None] == [("", 9, 9)]
    assert got(passages.remove_repeated(docs(spark, [])), "doc_id") == []


def test_passages_that_start_and_end_within_sentences(spark):
    inner = " ".join(prose(21, 5)).capitalize() + ". " + " ".join(prose(22, 12)).capitalize() + "."
    head, tail = " ".join(prose(23, 20)), " ".join(prose(24, 20))
    marks = "“" + " ".join(prose(25, 5)) + ".” " + " ".join(prose(26, 5)) + "?"
    rows = [
        (1, "One start " + head + ". " + inner + " " + tail + " one end."), (2, "Other beginning " + head + ". " + inner + " " + tail + " other end."),
        (3, "Own words. " + marks + " More of them."), (4, marks + " Nothing else here."),
    ]
    out = {i: (text, gone) for i, text, gone in got(passages.remove_repeated(docs(spark, rows)), "doc_id", "text", "n_removed")}
    assert out[1] == (rows[0][1], 0) and out[3] == (rows[2][1], 0)
    assert out[2] == ("Other beginning " + head + ". " + tail.strip() + " other end.", 2)
    assert out[4] == ("Nothing else here.", 2)


def test_passages_without_white_space(spark):
    shared = "他昨天说：「今天的天气很好。」我们去公园散步吧！"
    rows = [(1, "首先要说的是。" + shared + "完了。"), (2, "第二篇。" + shared + "再见。"), (3, "こんにちは。" + shared + "OK. またね。"), (4, "好。不好。"), (5, "好。不好。")]
    out = {r[0]: r[1:] for r in got(passages.remove_repeated(docs(spark, rows)), "doc_id", "text", "n_sentences", "n_removed")}
    assert out[1] == (rows[0][1], 4, 0) and out[2] == ("第二篇。再见。", 4, 2) and out[3] == ("こんにちは。OK. またね。", 5, 2)
    assert out[4] == out[5] == ("好。不好。", 2, 0)
    raw = np.frombuffer("「中文。」abc字x 、データ。End「文」".encode(), np.uint8)
    start, end, _, _ = passages.words(raw, np.array([0, len(raw)]))
    assert [raw[i:j].tobytes().decode() for i, j in zip(start, end, strict=True)] == ["「", "中", "文。」", "abc", "字x", "、", "デー", "タ。", "End「", "文」"]


# --- packing ---------------------------------------------------------------------------------

@pytest.mark.parametrize("limits", [(2048, 256, 2048), (64, 3, 40)])
def test_packing_round_trip(spark, limits):
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    texts = [None, "", "Hi", "it's <|endoftext|> a test ok É É", *[" ".join(prose(k, 10 * k)) for k in range(25)], "don't " * 4_000, "Hi", "a\0b \0 c\0 !\0"]
    rows = docs(spark, list(enumerate(texts))).withColumn("prompt", F.lit("Say it:"))
    found = packing.pack(rows.repartition(3), path, prompt_col="prompt", max_tokens=limits[0], max_segments=limits[1], max_loss=limits[2]).collect()
    ask = plain.encode("Say it:", add_special_tokens=False).ids
    for i, text in enumerate(texts):
        ids = [*ask, *plain.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        mine = sorted((r for r in found if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(r.ids for r in mine) == np.array(ids, "<u4").tobytes()
        assert sum(r.n_loss for r in mine) == len(ids) - len(ask) and all(r.doc_tokens == len(ids) for r in mine)
        assert [r.start for r in mine] == [0, *itertools.accumulate(r.length for r in mine)][:-1]
    for _, group in itertools.groupby(sorted(found, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        group = list(group)
        total = sum(r.length for r in group)
        assert [r.offset for r in group] == [0, *itertools.accumulate(r.length for r in group)][:-1]
        assert total == group[0].sequence_length <= limits[0] and len(group) <= limits[1] and sum(r.n_loss for r in group) <= limits[2]
    assert packing.pack(docs(spark, []), path).count() == 0


def test_words_that_differ_in_case_or_signs_are_tokenized_once():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        tokens = packing.WordTokens(file.read())
    for text, known in (("Word word, WORD. (word) -word", 6), ("word", 6), ("\u00e9t\u00e9, \u00c9T\u00c9", 8)):  # only A-Z are folded
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = tokens.encode(raw, np.array([0, len(raw)]))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids and len(tokens.hashes) == known
    pick = random.Random(3)
    parts = ["a", "The", "don't", "'S", "'re", "'", "-", "\"", "H\u0331", "h\u0331", "e", "\u0301", "\u00c9", "\u00d7", "\u00f7", "\u00df",
             "\u0130", "\u4e2d", "1", "\u00b2", "\0", "\x1c", "\x85", "\xa0", " ", " ", "\n", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "</w>", ">", "!"]
    texts = ["".join(pick.choices(parts, k=25)) for _ in range(600)]
    data = [t.encode() for t in texts]
    ids, at = tokens.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_sequences_are_full(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = docs(spark, [(k, " ".join(prose(k, 3 + 37 * k % 400))) for k in range(200)]).coalesce(1)
    lengths = [n for (n,) in packing.pack(rows, path).select("sequence_id", "sequence_length").distinct().select("sequence_length").collect()]
    assert all(n & (n - 1) == 0 for n in lengths) and lengths.count(2048) >= len(lengths) - 11


# --- quality ----------------------------------------------------------------------------------

def test_quality(spark):
    good = [(k, sentences(k, 8)) for k in range(200)]
    bad = [(k, " ".join(w + "%%%" for w in prose(k, 60))) for k in range(200, 400)]
    odd = [(900, None), (901, ""), (None, sentences(5, 5)), (902, "wort " * 30_000), (3, good[3][1])]
    table = docs(spark, [*good, *bad, *odd])
    labels = spark.createDataFrame(
        [*((k, 1, 0) for k in range(200)), *((k, 0, 0) for k in range(200, 400)), (900, None, 0), (None, 1, 0), (7, 0, 0), (8, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    trees = quality.train(table, labels)
    scored = quality.score(table, trees)
    assert scored.columns == [*[c for c in table.columns if c != "score"], "score"]
    out = scored.collect()
    assert len(out) == len(good) + len(bad) + len(odd) and all(0 <= r.score <= 1 for r in out)
    unseen = [r for r in got(scored.where(quality.held_out(scored.doc_id) & (scored.doc_id < 400)), "doc_id", "score")]
    assert len(unseen) > 40 and all((s >= 0.5) == (i < 200) for i, s in unseen)
    empty = quality.train(table, labels.limit(0))
    assert {r.score for r in quality.score(table, empty).collect()} == {0.5}
    assert quality.score(docs(spark, []), trees).count() == 0


def test_trees_learn_an_interaction():
    x = np.random.default_rng(0).random((2_000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    trees = quality.fit(x[:1_500], y[:1_500])
    assert ((trees.score(x[1_500:]) > 0.5) == y[1_500:]).mean() > 0.97


def test_features_of_odd_texts():
    for text in (b"", b"\n\n", b"   ", "é".encode(), b"a" * 100_000):
        x = quality.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert x.shape == (1, len(quality.FEATURES)) and np.isfinite(x).all()
    assert not quality.features(np.zeros(0, np.uint8), np.array([0, 0])).any()


# --- html ----------------------------------------------------------------------------------------

BODY = "This paragraph is long enough to be the beginning of a text by the sums of its lines."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<nav><a href=x>x</a></nav>", ""), ("plain &amp; simple", "plain & simple"),
    ("<article><h1>T</h1><p>a\n b&nbsp;c<p>d</article><footer>f</footer>", "T\na b c\nd"),
    ('<div class="ad">Buy</div><article><p>A<div class="share-box">x</div><p>B</article>', "A\nB"),
    (f"<div id=menu><p>Menu</p></div><div><h2>T</h2><p>{BODY}</p><ul><li>one<li>two</ul></div><p>{'<a>x</a> ' * 3}</p>", f"T\n{BODY}\none\ntwo"),
    (f'<main><p>{BODY}</p><section id="comments"><article class="comment"><p>{BODY}</p></article></section></main>', BODY),
    ('<script>if (a < b) "</p><p>x"</script><style>p{}</style><article><p>1 &lt; 2 <b>and</b> <i>so</i></p></article>', "1 < 2 and so"),
    ('<body class="has-sidebar"><article><header><h1>T</h1></header>x<!-- <p>no</p> --><br>y</article><aside>z</aside></body>', "T\nx y"),
    ("<article><p>a</p><aside>1</aside><aside>2</aside><aside>3</aside><p>b</p></article>", "a\nb"),
    (f"<div><h1>Title</h1></div><div><p>{BODY}</p></div>", f"Title\n{BODY}"),
    (f"<body><div><div><div><h2>Part</h2><p>Short.</p></div><div><div><p>{BODY}</p></div></div><div><div><p>The end.</p></div></div></div></div>"
     "<div><div><p><a href=x>More</a></p></div></div><div><div><p>Far away</p></div></div></body>", f"Part\nShort.\n{BODY}\nThe end."),
    (f"<div><div><h1>T</h1></div></div><div><div><div><p>{BODY}</p></div></div></div>", f"T\n{BODY}"),
    (f"<div class=nav><p>Menu</p></div><div><p>{BODY}</p></div><div><p>Between</p></div><div><p>{BODY}</p></div><div id=footer>f</div>",
     f"{BODY}\nBetween\n{BODY}"),
    ("<article><p>never closed <b>text", "never closed text"), ('<p title="a>b">x</p>', "x"), ("<p hidden>no</p><p>yes</p>", "yes"),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", 0), (1, "u", "<p>a</p>", 0), (None, None, None, 0)], "page_id long, url string, html string, text int")
    assert got(html.extract(pages), "page_id", "url", "text") == [(1, "u", "a"), (1, "u", "a"), (None, None, "")]
    assert html.extract(pages.limit(0)).count() == 0


# --- chat ------------------------------------------------------------------------------------------

def cheapest(codes):
    """Least cost over all role assignments, by trying them."""
    best = 1 << 30
    for roles in itertools.product((1, 2, 3), repeat=len(codes)):
        state, cost = chat.START, 0
        for code, role in zip(codes, roles, strict=True):
            cost += 0 if code == role else chat.RELABEL if code else chat.NAME
            ways = [chat.MERGE] if state == role else []
            if chat.INSERTED[state, role] is not None:
                ways.append(chat.INSERT * len(chat.INSERTED[state, role]))
            if not ways:
                break
            cost, state = cost + min(ways), role
        else:
            best = min(best, cost + chat.INSERT * len(chat.CLOSING[state]))
    return best


def cost_of(out, codes):
    fixed = {"keep": 0, "merge": chat.MERGE, "insert": chat.INSERT, "relabel": 0, "relabel+merge": chat.MERGE}
    total = 0
    for k, _, action, *_ in out:
        total += fixed[action]
        if "relabel" in action:
            total += chat.RELABEL if codes[k] else chat.NAME
    return total


def legal(rendering):
    roles = re.findall(r"<\|(system|user|assistant)\|>\n", rendering)
    roles = roles[1:] if roles[:1] == ["system"] else roles
    return all(r == ("user", "assistant")[k % 2] for k, r in enumerate(roles)) and len(roles) % 2 == 0


def test_repair_is_cheapest():
    for n in range(6):
        for codes in itertools.product(range(4), repeat=n):
            states, _ = chat.repair(np.array(codes, np.int64), chat.START, None)
            out = chat.rendered([(c, "t") for c in codes], states, chat.START, True)
            assert cost_of(out, codes) == cheapest(codes)
            assert legal("".join(x[4] for x in out))


def test_chats(spark, monkeypatch):
    pick, rows = random.Random(2), []
    for conv in range(40):
        n = 700 if conv == 7 else pick.randrange(1, 9)
        rows += [(conv, k, pick.choice(["user", "assistant", "system", "Human", None, "tool"]), pick.choice(["hi", "", None, "<|user|>"]), 1) for k in range(n)]
    rows += [(None, None, "user", "a", 1), (None, 0, "gpt", "b", 1), (3, 0, "user", "same", 1), (3, 0, "user", "same", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")
    whole = sorted(got(chat.format_chats(table), "conv_id", "place", "turn", "role", "action", "text", "piece"), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    monkeypatch.setattr(chat, "PART_ROWS", 50)
    parts = sorted(got(chat.format_chats(table), "conv_id", "place", "turn", "role", "action", "text", "piece"), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for out in (whole, parts):
        assert sum(r[4] != "insert" for r in out) == len(rows)
        for conv, mine in itertools.groupby(out, key=lambda r: r[0]):
            mine = list(mine)
            assert legal("".join(r[6] for r in mine))
            given = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None))
            assert [r[2] for r in mine if r[4] != "insert"] == [r[1] for r in given]

    def cost(out):
        fixed = {"keep": 0, "merge": 1, "insert": 3, "relabel": 0, "relabel+merge": 1}
        return {c: sum(fixed[r[4]] for r in g) for c, g in itertools.groupby(out, key=lambda r: r[0])}

    assert cost(whole).keys() == cost(parts).keys()
    assert chat.format_chats(table.limit(0)).count() == 0


# --- licences ----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model(spark):
    return licences.train(docs(spark, [(k, sentences(k, 3) + "\n" + sentences(k + 500, 2)) for k in range(300)]))


def test_licences(spark, model):
    noise = sentences(99, 4)
    rows, want = [(900, None), (901, ""), (902, "A driver must show a license."), (903, noise), (904, "Licensed under the Apache License")], {}
    for k, (family, text) in enumerate((f, t) for f, ts in licences.TEMPLATES.items() for t in ts):
        rows.append((k, noise + "\n" + text.upper() + "\n" + noise))
        rows.append((k + 100, text + " " + noise * 200))
        want[k, 1] = want[k + 100, 0] = family
    rows.append((0, rows[5][1]))
    found = got(licences.scan(docs(spark, rows), model), "doc_id", "paragraph_no", "family", "probability", "similarity")
    assert {(i, k): f for i, k, f, _, _ in found if f != licences.UNKNOWN} == want
    assert sum(1 for r in found if r[:2] == (0, 1)) == 2
    assert all(0 < p <= 1 and 0 <= s <= 1 for *_, p, s in found)
    assert licences.scan(docs(spark, []), model).count() == 0


def test_licence_notices_in_several_lines(spark, model):
    noise = sentences(98, 3)
    mit = licences.TEMPLATES["MIT"][2].split()
    wrapped = "/*\n * " + "\n * ".join(" ".join(mit[k : k + 8]) for k in range(0, len(mit), 8)) + "\n */"
    heading = "    GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007"
    gpl = licences.TEMPLATES["GPL-3.0"][1].replace("the Free", "the\n# Free").replace("it under", "it\n# under")
    share_alike = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    rows = [
        (1, noise + "\n\n" + wrapped + "\n\n" + noise), (2, noise + "\n\n\n" + heading + "\n\n" + noise), (3, "# " + gpl),
        (4, "# " + gpl.replace("version 3", "version 2")), (5, share_alike), (6, "\n" + licences.TEMPLATES["MIT"][2] + "\n" + noise), (7, wrapped + "\n" + noise),
    ]
    found = got(licences.scan(docs(spark, rows), model).where("family <> 'unknown'"), "doc_id", "paragraph_no", "family")
    assert sorted(found) == [(1, 3, "MIT"), (2, 3, "GPL-3.0"), (3, 0, "GPL-3.0"), (6, 1, "MIT"), (7, 1, "MIT")]


def test_needles_reach_every_confirmable_paragraph(model):
    """Whatever a fifth of a template's pairs is taken away, a needle is left."""
    pick = random.Random(1)
    for _, own in model.templates:
        for _ in range(50):
            lacking = pick.sample(own, int((1 - licences.SHARE) * len(own) + 1e-9))
            assert any(needle in p for p in own if p not in lacking for needle in model.needles)


def test_plans_run_no_python(spark, model):
    plans = [licences.scan(docs(spark, [(1, "a")]), model), exact.deduplicate(docs(spark, [(1, "a")]), exact.DigestIndex.fresh(spark, 2))]
    assert not any(re.search("Python|Arrow|Pandas", p._jdf.queryExecution().executedPlan().toString()) for p in plans)
