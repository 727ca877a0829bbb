"""Quality rules, line dedup, decontamination, near dedup, packing and counts on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from scanledger.llm import decontaminate, line_dedup, near_dedup, packing, quality, token_counts
from tests.llm.data import changed, documents, prose, rows, with_clashes

LONG = prose(1, 30_000)
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, LONG), (None, "no id at all"), (7, "tie"), (7, "tie"), (8, "é ü \u3000 x")]


# --------------------------------------------------------------------------------------------------------- quality


def brute_repeats(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len({i + d for v in at.values() if len(v) > 1 for i in v for d in range(3)})


def test_quality_counts(spark):
    draw = random.Random(3)
    texts = [" ".join(draw.choice("abc") for _ in range(n)) for n in range(40)] + [t for _, t in EDGES]
    found = quality.query(with_clashes(documents(spark, list(enumerate(texts))))).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.n_repeat_words == brute_repeats(texts[r.doc_id]), texts[r.doc_id][:80]


def test_quality_lines(spark):
    body = prose(5, 80)
    cases = {
        1: (body + "\nHome | About | Shop | Cart", body, True), 2: (body + "\nno end here", body, True),
        3: ("nothing ends " * 40, "", False), 4: (body + "\nAll rights reserved.", body, True), 5: (body, body, True),
    }
    docs = documents(spark, [(k, v[0]) for k, v in cases.items()])
    kept = {r.doc_id: r.text for r in quality.keep_quality(docs).collect()}
    assert kept == {k: clean for k, (_, clean, keeps) in cases.items() if keeps}


def test_quality_keeps_columns_and_repeats(spark):
    docs = with_clashes(documents(spark, [(1, prose(5))] * 2 + EDGES))
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns and kept.count() == 3  # the two copies and the long text


# ------------------------------------------------------------------------------------------------------ line dedup


def test_cuckoo_filter_inserts_and_deletes():
    hashes = np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64)
    made = line_dedup.CuckooFilter.of(hashes)
    assert made.contains(hashes).all()
    others = np.random.default_rng(2).integers(0, 2**63, 50_000).astype(np.uint64)
    assert made.contains(others).mean() < 0.001
    before = np.sort(made.table.ravel())
    assert made.insert(others[:1000])
    made.delete(others[:1000])
    assert made.contains(hashes).all() and (np.sort(made.table.ravel()) == before).all()
    made.delete(hashes)
    assert not made.table.any()


def brute_lines(table):
    holders = {}
    key = lambda x: x.strip(" \t\n\r\x0b\x0c").translate({c: c + 32 for c in range(65, 91)})
    for doc, text in table:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in table:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (doc is not None and len(holders.get(key(x), ())) >= 3 and doc < max(holders[key(x)]))]
        out.append((doc, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_table(n=60):
    draw = random.Random(9)
    pool = [prose(100 + i, 8) for i in range(12)]
    table = [(i, "\n".join(draw.choice([x, f"  {x.upper()}\t", x]) for x in draw.choices(pool, k=draw.randint(0, 6)))) for i in range(n)]
    return table + [(r[0] + 1000 if r[0] is not None else None, r[1]) for r in EDGES] + [(None, pool[0])]


def test_line_dedup(spark):
    table = line_table()
    found = line_dedup.query(with_clashes(documents(spark, table)))
    assert rows(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute_lines(table)


def test_line_dedup_is_reversible(spark):
    def shown(state):
        return rows(state.counts, "key", "n", "largest"), rows(state.references, "key", "doc_id")

    table = [r for r in line_table() if r[0] is not None]
    first = line_dedup.insert(line_dedup.empty_state(spark), documents(spark, table[:40]))
    before = shown(first)
    second = line_dedup.insert(first, documents(spark, table[40:]))
    all_at_once = line_dedup.insert(line_dedup.empty_state(spark), documents(spark, table))
    assert shown(second) == shown(all_at_once)
    assert rows(line_dedup.drop_lines(second, documents(spark, table)).selectExpr("doc_id", "deduped.kept"), "doc_id", "kept") == rows(
        line_dedup.drop_lines(all_at_once, documents(spark, table)).selectExpr("doc_id", "deduped.kept"), "doc_id", "kept"
    )
    held = {r[0] for r in table[:40]}
    back = line_dedup.delete(second, documents(spark, [r for r in table[40:] if r[0] not in held]))
    assert shown(back) == before
    # the filters say yes to every frequent key of the state, after all moves
    frequent = [bytes(r.key) for r in back.counts.filter("n >= 3").collect()]
    blobs = [line_dedup.CuckooFilter.load(r["filter"]) for r in back.filters.collect()]
    assert any(b.contains(line_dedup._hashes(frequent)).all() for b in blobs)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.query(documents(spark, [])).count() == 0


# -------------------------------------------------------------------------------------------------- decontamination


def brute_hits(table, items, size=10):
    split = lambda t: [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
    wins = {}
    for item, text in items:
        w = split(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in table:
        w, hit, own = split(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in wins:
                    hit |= set(range(i, i + k))
                    own |= wins[tuple(w[i : i + k])]
        ids = sorted(str(x) for x in own if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("short", [True, False])
def test_decontamination(spark, short):
    passage = prose(40, 25)
    items = [(1, passage), (2, passage), (None, prose(41, 12)), (3, None), (4, ""), (5, prose(42, 10))]
    items += [(6, "Só três palavras"), (7, "tie")] if short else []
    table = [
        *EDGES, (20, prose(2) + " " + passage.upper() + " " + prose(3)), (21, " ".join(passage.split(" ")[3:14])),
        (22, " ".join(passage.split(" ")[3:12])), (23, prose(41, 12) * 2), (24, "x só três palavras y"), (25, passage), (25, passage), (25, "other"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.query(with_clashes(documents(spark, table)), benchmark)
    want = brute_hits(table, items)
    assert rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    docs = with_clashes(documents(spark, table))
    left = decontaminate.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(w[0]) for w in want if not w[5])


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, EDGES)
    assert {r.n_hit for r in decontaminate.query(docs, none).collect()} == {0}
    assert decontaminate.query(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == len(EDGES)


# ------------------------------------------------------------------------------------------------------ near dedup


def brute_classes(table):
    def shingles(t):
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if x]
        k = min(5, len(w))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()

    sets = [shingles(t) for _, t in table]
    root = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = table[i][1] is not None and table[i][1] == table[j][1]
            if same or (a and b and len(a & b) >= 0.8 * len(a | b)):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    least = {}
    for i, r in enumerate(root):
        ids = [table[j][0] for j in range(len(table)) if root[j] == r and table[j][0] is not None]
        least[i] = min(ids, default=None)
    return sorted(((table[i][0], least[i]) for i in range(len(table))), key=repr)


def near_table():
    base, other = prose(60, 200), prose(61, 90)
    table = list(EDGES)
    table += [(100 + i, changed(base, 20 * i, f"new{i}")) for i in range(9)] + [(99, base), (130, base), (131, base)]
    chain = other
    for i in range(6):  # each link holds, the ends are far apart
        chain = changed(changed(chain, 12 * i, f"c{i}"), 12 * i + 5, f"d{i}") if i else chain
        table.append((200 + i, chain))
    return table + [(300, "!!!"), (301, "!!!"), (302, "???"), (303, "one two"), (304, "One, two!"), (305, prose(70)), (306, prose(71))]


def test_near_duplicates(spark):
    table = near_table()
    found = near_dedup.query(with_clashes(documents(spark, table)))
    assert rows(found, "doc_id", "class_id") == brute_classes(table)


def test_one_of_each_class_stays(spark):
    table = near_table()
    docs = with_clashes(documents(spark, table))
    kept = near_dedup.dedup_near(docs)
    assert kept.columns == docs.columns
    want = {c for _, c in brute_classes(table)}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(x) for x in want)
    assert near_dedup.dedup_near(docs.limit(0)).count() == 0


def test_a_large_group_of_near_copies(spark):
    base = prose(80, 150)
    draw = random.Random(4)
    table = []
    for i in range(300):  # one to eight changed words: some reach others only through the base, some nothing
        text = base
        for _ in range(draw.randint(1, 8)):
            text = changed(text, draw.randrange(150), f"w{i}x{draw.randrange(10**6)}")
        table.append((i, text))
    found = near_dedup.query(documents(spark, table))
    assert rows(found, "doc_id", "class_id") == brute_classes(table)


def test_near_copies_with_a_block_repeated_many_times(spark):
    table = []
    for i in range(30):
        base = prose(900 + i, 100)
        block = " ".join(base.split(" ")[20:45])
        table += [(2 * i, base), (2 * i + 1, changed(base, 60) + f" {block}" * 1000)]
    want = brute_classes(table)
    assert [c for _, c in want] == [d - d % 2 for d, _ in want]
    found = near_dedup.query(documents(spark, table))
    assert rows(found, "doc_id", "class_id") == want


def test_bands_of_a_node_are_distinct():
    elements = np.random.default_rng(3).integers(0, 2**63, 50).astype(np.uint64)
    plain = near_dedup.bands(elements, np.ones(50, dtype=np.int64))
    repeated = near_dedup.bands(elements, np.r_[2, np.ones(49, dtype=np.int64)])
    assert len(set(repeated.tolist())) == len(repeated) and set(plain.tolist()) <= set(repeated.tolist())


def test_prob_min_hash_estimates_weighted_similarity():
    draw = np.random.default_rng(0)
    agree = []
    for _ in range(30):
        a = draw.integers(0, 2**63, 300).astype(np.uint64)
        b = np.r_[a[:200], draw.integers(0, 2**63, 100).astype(np.uint64)]
        heavy = np.r_[np.full(200, 3.0), np.ones(100)]
        agree.append((near_dedup.prob_min_hash(a, heavy, 125) == near_dedup.prob_min_hash(b, heavy, 125)).mean())
    assert abs(np.mean(agree) - 600 / 800) < 0.03  # equal weights and totals: shared weight over all weight


def test_components_of_a_chain(spark):
    key = lambda i: i.to_bytes(4, "big")
    links = spark.createDataFrame([(key(i), key(i + 1)) for i in range(40)] + [(key(90), key(91))], "a binary, b binary")
    found = {bytes(r.node): bytes(r.root) for r in near_dedup.components(links).collect()}
    assert found == {key(i): key(0) for i in range(41)} | {key(90): key(90), key(91): key(90)}


# --------------------------------------------------------------------------------------------------------- packing


@pytest.mark.parametrize("n", [1, 30, 3000])
def test_solver_places_everything(n):
    draw = np.random.default_rng(n)
    histogram = {int(k): int(c) for k, c in zip(*np.unique(draw.integers(1, 1025, n), return_counts=True), strict=True)}
    made = packing.solve(histogram, rounds=20)
    placed = {}
    for config, times in made:
        assert sum(config) <= 1024 and times > 0
        for k in config:
            placed[k] = placed.get(k, 0) + times
    assert placed == histogram
    least = -(-sum(k * c for k, c in histogram.items()) // 1024)
    assert sum(t for _, t in made) <= 1.05 * least + 1


def test_solver_does_not_grow_with_the_counts():
    small = {k: 1000 for k in range(100, 1000, 7)}
    assert len(packing.solve({k: c * 10**9 for k, c in small.items()}, rounds=20)) < 100 * len(small)


def test_packing(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a  b", " a", "a ", "a\n\nb", "it's 1,2 3.5 a.\nB\n\nC d\n", "tab\tand nbsp\xa0x", "'s 't, 'll. x'\ny", "q.\nThe cat,\nno", "end\n", "\u3000x y", "<|endoftext|> x"]
    table = [*EDGES, *((500 + i, t) for i, t in enumerate(odd)), (600, prose(8, 1200)), (601, "")]
    found = packing.query(with_clashes(documents(spark, table))).collect()
    want, pieces = [], {}
    for doc, text in table:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((doc, k, a, b - a, zlib.crc32(np.asarray(ids[a:b], dtype="<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=repr) == sorted(want, key=repr)
    for r in found:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in pieces.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.query(documents(spark, [])).count() == 0


def test_encoder_gives_the_ids_of_the_file():
    """Every code point, and texts of what tokenizers treat specially, against the tokenizer itself."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model, encode = Tokenizer.from_file(path), packing.text_encoder(path)
    same = lambda t: np.frombuffer(encode(t), dtype="<u4").tolist() == model.encode(t, add_special_tokens=False).ids
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1000):
        assert same("\n".join(f"a{c}1 {c}b{c}{c}.{c} {c}" for c in map(chr, points[at : at + 1000]))), hex(points[at])
    draw = random.Random(2)
    parts = [*"ab Z09 \n\t\r.,'’—é漢\xa0\u2028\u200b\u3000\x85\x1cć\U0001f600ſ", "<|endoftext|>", "<|endoftext", "'s", "'LL", "don't", "  ", "\n\n"]
    assert all(same("".join(draw.choice(parts) for _ in range(draw.randint(0, 30)))) for _ in range(20_000))
    assert same("a" * 30_000) and same(LONG)


def test_other_files_go_through_their_own_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = Tokenizer.from_file(path).encode("Some Words, twice", add_special_tokens=False).ids
    assert np.frombuffer(packing.text_encoder(path)("Some Words, twice"), dtype="<u4").tolist() == ids


def test_equal_pieces_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BUCKET", 10)
    found = packing.query(documents(spark, [(None, "same")] * 100)).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == 100


def test_packing_knows_the_added_token(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [end, f"a {end} b", f"a{end}b", f"a\n{end}\nb c", f"it is {end}. So, {end}, 'x", f"{end}'s {end}{end} y", f"a  {end}  b\n\n{end}", f"<|endof text|> {end}!"]
    assert all(50256 in model.encode(t, add_special_tokens=False).ids for t in texts)
    found = {r.doc_id: r.ids_crc32 for r in packing.query(documents(spark, list(enumerate(texts)))).collect()}
    want = {i: np.asarray([*model.encode(t, add_special_tokens=False).ids, 2], dtype="<u4") for i, t in enumerate(texts)}
    assert found == {i: zlib.crc32(ids.tobytes()) for i, ids in want.items()}


def test_packing_with_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = packing.pack_documents(documents(spark, [(1, prose(8, 900)), (2, "x")]), path, with_ids=True).collect()
    assert all(len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.asarray(r.ids, dtype="<u4").tobytes()) for r in found)


# ---------------------------------------------------------------------------------------------------- token counts


def greedy(word, start, inside):
    n, known = 0, start
    while word:
        for k in range(len(word), 0, -1):
            if word[:k] in known:
                break
        else:
            return -1
        word, known, n = word[k:], inside, n + 1
    return n


def test_automaton_is_greedy_longest_match():
    draw = random.Random(1)
    piece = lambda: bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 4)))
    for _ in range(2000):
        start, inside = {piece() for _ in range(5)}, {piece() for _ in range(5)}
        made = token_counts.PieceAutomaton(sorted(start), sorted(inside))
        word = b"".join(piece() for _ in range(draw.randint(0, 3)))
        assert made.count(word) == greedy(word, start, inside)


def test_token_counts(spark):
    vocabulary = set(token_counts.byte_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    table = [r for r in EDGES if r[0] != 5] + [(5, prose(1, 500))]
    found = token_counts.query(with_clashes(documents(spark, table)))
    want = []
    for doc, text in table:
        words = token_counts.WORD.findall(text or "")
        assert "".join(words) == (text or "")
        want.append((doc, len(words), sum(greedy(w.encode(), vocabulary, vocabulary) for w in words), 0))
    assert rows(found, "doc_id", "n_words", "n_tokens", "n_unknown") == sorted(want, key=repr)
    assert token_counts.query(documents(spark, [])).count() == 0


def test_line_dedup_stage_with_clashes_nulls_and_repeats(spark):
    from pyspark.sql import functions as F

    line, other = "A line of more than twenty characters", "\t a LINE of more than twenty characters \r"
    table = [(1, f"{line}\nown text of one"), (2, f"two\n{other}"), (3, line), (3, line), (None, f"{line}\nnobody's"), (4, None), (5, ""), (6, "short\nshort"), (7, "short"), (8, "short")]
    docs = with_clashes(documents(spark, table)).select("*", *(F.lit(c).alias(c) for c in ("deduped", "kept", "n_lines", "keys_", "own_id", "doc")))
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.select("deduped", "kept", "own_id_").distinct().collect() == docs.select("deduped", "kept", "own_id_").distinct().collect()
    # the largest id keeps the line, in every copy of its row; a row without id is no document of the counts
    kept = {1: "own text of one", 2: "two", 3: line, None: f"{line}\nnobody's", 4: None, 5: "", 6: "short\nshort", 7: "short", 8: "short"}
    assert rows(out, "doc_id", "text") == sorted(((i, kept[i]) for i, _ in table), key=repr)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
