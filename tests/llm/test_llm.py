import itertools
import random
import string
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from loomspan.llm import encoding, frames, logistic, messages, mixing, neardup, packing, personal, residue, terms, truncation
from loomspan.session import persisted


# -- 1: frames -----------------------------------------------------------------


def cut_cost(side, odds, edges):
    terminal = sum(max(-o, 0) if x else max(o, 0) for x, o in zip(side, odds))
    return terminal + sum(c for a, b, c in edges if side[a] != side[b])


def test_min_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(400):
        n = rng.randint(1, 9)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 3)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        u, v, c = (np.array([e[k] for e in edges], float if k == 2 else int) for k in range(3))
        side = frames.min_cut(np.array(odds), u, v, c)
        best = min(cut_cost(s, odds, edges) for s in itertools.product([True, False], repeat=n))
        assert cut_cost(side, odds, edges) == pytest.approx(best)
    assert len(frames.min_cut(np.empty(0), *(np.empty(0, int),) * 2, np.empty(0))) == 0


def test_siblings_are_joined_beyond_neighbours():
    p = frames.Pages(["one\ntwo\nthree\n\nfour"], [None], frames.Known(({}, {}), {}))
    u, v, c = frames.page_edges(p)
    assert dict(zip(zip(u.tolist(), v.tolist()), c.tolist())) == {(0, 1): frames.NEAR, (1, 2): frames.NEAR, (2, 3): frames.FAR, (0, 2): frames.SIBLING}


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, source_url string, final_url string, text string, extra int, host int")


def test_frames_of_small_pages(spark):
    rng = random.Random(2)
    prose = lambda: " ".join("".join(rng.choices(string.ascii_lowercase, k=6)) for _ in range(14)).capitalize() + "."
    rows = []
    for i in range(60):
        body = prose() + "\n" + prose()
        text = f"Home | Pricing | Blog\nLog in\nAcme{i}x – reports made short\n{body}\nPlain words number {i} stand here for a while and then they end.\n© 2024 Acme. All rights reserved."
        rows.append((i, f"https://s.example/products/acme{i}x", "https://www.acme.example/p", text, i, i))
    rows += [(60, None, None, None, 0, 0), (61, None, None, "", 0, 0), (62, None, None, "\n \nA line that stands alone in the world and has nothing beside it.", 0, 0)]
    rows.append(rows[0])
    pages = _pages(spark, rows).filter("text is not null and text <> ''")
    got = {r["page_id"]: r["lines"] for r in frames.frame_lines(pages).collect()}
    assert len(got) == 61 and all(got[i] == [0, 1, 5, 6] for i in range(60))
    assert frames.frame_lines(pages.limit(0)).count() == 0


def test_frames_learn_from_every_page(spark):
    rows = [(i, None, None, f"Plain page {i}", 0, 0) for i in range(8000)]
    text = "Nav alpha\nAcme{0}x\nReal sentences stand here with many plain words in a row and then they end, page {0}.\n{1}"
    rows += [(8000 + i, f"https://s.example/products/acme{i}x", f"https://h{i}.example/", text.format(i, c), 0, 0) for i, c in enumerate("œжøłñąßčďę")]
    _, (weights, logs) = frames.prepared(_pages(spark, rows))
    # Ten pages of 8,010 give a phrase its weight, and a character of one page is counted.
    assert set(logs) == set("œжøłñąßčďę") and weights[0][frames.logistic.ids(["l:nav alpha"])[0]] > 0


def test_texts_are_read_three_times(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    text = "Log in\nAcme{0}x\nReal sentences stand here with many plain words in a row and then they end, page {0}."
    rows = [(i, f"https://s.example/products/acme{i}x", f"https://h{i % 3}.example/", text.format(i), 0, 0) for i in range(40)]
    pages = _pages(spark, rows)
    assert frames.frame_lines(pages.mapInArrow(counted, pages.schema)).count() == 40
    # For characters, shares and lines; fits and cuts work on what was kept.
    assert read.value == 120


def test_kept_pages_are_cut_alike():
    rng = np.random.default_rng(6)
    weights = tuple(rng.normal(size=frames.logistic.DIMENSIONS).astype(np.float32) for _ in range(2))
    texts = [f"Home | Blog\nAcme{i}x\n  Some words stand here, and they go on for a good while until the line ends.\n\n© 2024 Acme\n{'word ' * i}" for i in range(30)]
    known = frames.Known(weights, {})
    p = frames.Pages(texts, [f"https://s.example/acme{i}x" for i in range(30)], known)
    share, labeller = np.linspace(0, 1, p.size), frames.Labeller(weights, {})
    p.see(share, np.full(30, 25))
    row = {**p.packed(), **frames._examples(p, True)}
    again = frames.Pages.kept(row, weights)
    assert (labeller.frame(again, again.share) == labeller.frame(p, share)).all() and (again.last_prose == p.last_prose).all()


def test_a_fit_sums_all_blocks(spark):
    logistic = frames.logistic
    rng = np.random.default_rng(5)
    truth, rows = {0: 2.0, 1: -2.0, 2: 0.0}, []
    for _ in range(7):
        picked = [sorted(set(rng.integers(0, 3, 2).tolist())) for _ in range(200)]
        label = [int(rng.random() < 1 / (1 + np.exp(-sum(truth[x] for x in p)))) for p in picked]
        rows.append((picked, label))
    split = [logistic.block(p, range(200), [0] * 200, y, [0] * 200, [1] * 200) for p, y in rows]
    data = spark.createDataFrame([tuple(b.to_pylist()[0].values()) for b in split], logistic.SCHEMA).repartition(3)
    choose = lambda b: (b.label, b.label >= 0)
    w = logistic.fit(data, choose, dimensions=4)
    # At the minimum the gradient over all 1,400 examples and the penalty cancel.
    x = np.array([[float(k in p) for k in range(4)] for picked, _ in rows for p in picked])
    y = np.array([v for _, label in rows for v in label], float)
    g = x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + logistic.RIDGE * w
    assert np.abs(g).max() < 2e-3 and w[0] > 1 and w[1] < -1 and w[3] == 0


# -- 2: terms ------------------------------------------------------------------


def test_terms_split_and_count(spark):
    rows = [("k", i, ["Hot", f"term {i % 50}", None, "", "hot!", "Ünïque" if i == 3 else "hot"]) for i in range(400)]
    rows += [("k", 1000, None), ("k", 1001, []), ("k", 1002, [None, "-"])]
    df = spark.createDataFrame(rows, "field string, id long, elements array<string>").withColumnRenamed("x", "y")
    got = {r["term"]: (r["occurrences"], r["records"]) for r in terms.term_counts(df, leaf_rows=5).collect()}
    assert got["hot"] == (1199, 400) and got["unique"] == (1, 1) and got["term 7"] == (8, 8) and len(got) == 52
    assert terms.term_counts(df.limit(0)).count() == 0


# -- 3: encodings --------------------------------------------------------------

SENTENCES = ["Das Büro prüft die Größe — „gut“ für 5 €.", "L’été, la clinique vérifie les relevés à côté.", "¿Cuántas reseñas llegan mañana? Así es el año.", "Сервис проверяет договоры для школ и отзывы."]


def _model():
    counts: dict = {}
    for c in "".join(SENTENCES) * 3:
        if c > "\x7f":
            counts[c] = counts.get(c, 0) + 1
    total = sum(counts.values())
    return encoding.Model({c: np.log(n / total) for c, n in counts.items()})


@pytest.mark.parametrize("read", ["cp1252", "mac_roman", "cp1251", "cp437", "cp850", "iso8859_2"])
def test_garbled_text_comes_back(read):
    model = _model()
    for text in SENTENCES:
        assert model.repair(text) == (text, [])
        try:
            bad = text.encode().decode(read)
        except UnicodeDecodeError:
            bad = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in text.encode())
        fixed, found = model.repair(bad)
        assert found and fixed == text


def test_other_damage():
    model = _model()
    twice = "é à".encode().decode("cp1252").encode().decode("cp1252")
    assert model.repair(twice)[0] == "é à"
    often = "Büro – été"
    for _ in range(5):
        often = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in often.encode())
    assert model.repair(often)[0] == "Büro – été"
    assert model.repair("".join(f"&#{ord(c)};" if c > "\x7f" else c for c in "relevés".encode().decode("cp1252")))[0] == "relevés"
    assert model.repair("les rйgies vйrifient")[0] == "les régies vérifient"
    assert model.repair("caf� bar")[1] == ["lost"]
    assert model.repair("SÃO Paulo, NÃO")[1] == [] and model.repair("")[1] == []


def test_characters_are_counted_in_stretches(monkeypatch):
    rng, looked = random.Random(9), []
    texts = ["".join(rng.choices("ab é–бÃ©ãя�ÀÈ", weights=[9, 9, 9, *[1] * 10], k=40)) for _ in range(300)] + ["é", "бвa", "Plain words, " * 50 + "é " + "and more of them. " * 50] * 20
    counts: dict = {}
    for text in texts:
        for c in encoding._SUSPICIOUS.sub(" ", text):
            if c > "\x7f":
                counts[c] = counts.get(c, 0) + 1

    class Watched:
        def sub(self, by, text, pattern=encoding._SUSPICIOUS):
            looked.append(len(text))
            return pattern.sub(by, text)

    monkeypatch.setattr(encoding, "_SUSPICIOUS", Watched())
    (got,) = encoding._count_characters(iter([pa.RecordBatch.from_arrays([pa.array([*texts, None, "", "plain"])], names=["text"])]))
    assert dict(zip(*got.to_pydict().values())) == counts
    assert all(encoding._candidates(t * k) == set(encoding._CANDIDATE.findall(t * k)) for t in texts for k in (1, 20))
    # The pattern sees nothing of plain words, and a stretch once.
    assert sum(looked) < sum(map(len, texts[:300])) and max(looked) <= 40


# -- 4: residue ----------------------------------------------------------------


def test_placeholders():
    for text in ("Hi {{ user.name }}", "Welcome to ${city}", "<%= title %>", "[INSERT name]", "[Your title here]", "%%a%%", "@@b@@", "&lt;BRAND&gt;", "{tagline}"):
        assert messages.unfilled(text), text
    for text in ("Type {{first_name}} in a mail and it fills in the name.", "Use ${total} or <%= total %> in invoices; both notations are understood.", "a < b and c > d", ""):
        assert not messages.unfilled(text), text


def test_messages_are_taken_apart_and_masked():
    got = [m for m, _ in messages.sentences("Text goes here. Text goes here. undefined undefined asdf asdf qwer Error 404: Not found")]
    assert got == ["text goes here", "text goes here", "undefined undefined", "asdf asdf qwer", "error 0 not found"]
    assert messages.mask(messages.plain("Request id a3334d7fdd03 of a@b.example at https://x.example/1")) == "request id 0 of 0 at 0"
    assert messages.sentences("") == [] and not messages.residue_line("")


def test_real_content_beside_a_message_is_none(spark):
    message = "Access denied. Please try again in a few minutes."
    rows = []
    for i in range(12):
        body = "The quiet engine sorts long reports for the teams of the town every single day." if i % 2 else ""
        rows.append((i, f"https://s.example/products/name{i}x", f"https://h{i}.example/", f"Name{i}x", f"Name{i}x\n{body}\n{message}", None, i))
    df = spark.createDataFrame(rows, "page_id long, source_url string, final_url string, title string, text string, description string, messages int")
    assert {r["page_id"] for r in residue.residue(df).collect()} == {i for i in range(12) if i % 2 == 0}


def test_residue_needs_two_sources(spark):
    error = "404 Not Found\nThe page you are looking for does not exist or has moved."
    rows = [(i, f"https://s.example/products/p{i}", f"https://h{i}.example/", t, error if i < 2 else "Real words about real things, and quite a few of them too.", None) for i, t in enumerate(["Access denied | H0", "404 page designer", None])]
    rows += [(9, None, None, "", "", "  "), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, source_url string, final_url string, title string, text string, description string")
    assert {tuple(r) for r in residue.residue(df).collect()} == {(0, "text", "message"), (1, "text", "message")}
    assert (0, "title", "message") in {tuple(r) for r in residue.residue(df, 1).collect()}
    assert residue.residue(df.limit(0)).count() == 0


def test_residue_judges_by_a_model_of_all_pages(spark):
    rows = [(i, None, None, f"Plain page {i}", 0, 0) for i in range(8000)] + [(8000 + i, None, None, f"Line {c}", 0, 0) for i, c in enumerate("œжøłñąßčďę")]
    held = spark.createDataFrame([(1, [5])], "page_id long, residue array<long>")
    # Asked for one page as p4 does, with its column.
    joined, (_, logs) = frames.prepared(_pages(spark, rows), held)
    assert set(logs) == set("œжøłñąßčďę") and [tuple(r) for r in joined.select("page_id", "residue").collect()] == [(1, [5])]


def test_residue_leaves_no_blocks_of_pages(spark):
    from loomspan.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file://"), "loomspan")
    kept = lambda: {x.name for x in folder.glob("*") if x.name.startswith(("frame-examples", "line-counts"))}
    before = kept()
    rows = [(i, None, f"https://h{i}.example/", None, "404 Not Found\nThe page you are looking for does not exist or has moved.", None) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, source_url string, final_url string, title string, text string, description string")
    assert residue.residue(df).count() == 3 and kept() <= before


# -- 5: truncation -------------------------------------------------------------


def test_cuts_are_found_in_held_out_values(spark):
    rng = random.Random(3)
    nouns, verbs = ["reports", "invoices", "lessons", "drafts", "tickets"], ["sorts", "merges", "checks", "ranks", "labels"]
    sentence = lambda: f"The {rng.choice('quiet calm sturdy plain sharp'.split())} engine {rng.choice(verbs)} {rng.choice(nouns)} for {rng.choice(nouns)} teams."
    whole = [" ".join(sentence() for _ in range(4)) for _ in range(700)]
    cut = [w[: rng.randint(60, len(w) - 3)] for w in whole[500:]]
    cut = [c for c in cut if not c.rstrip().endswith(".")]
    rows = [("source_products", i, "f", w, 1) for i, w in enumerate(whole[:500])]
    rows += [("source_products", 5000, None, "", 1), ("source_products", 5001, None, None, 1), rows[0]]
    df = spark.createDataFrame(rows, "tbl string, row_id long, source string, text string, extra int")
    ends = truncation.train(df)
    judge = lambda t: ends.score("source_products", "f", t) > truncation.THRESHOLD
    assert sum(map(judge, cut)) >= 0.97 * len(cut) and sum(map(judge, whole[500:])) <= 4
    assert truncation.scored(df).count() == 500
    assert truncation.scored(df.limit(0)).count() == 0


def test_ends_learn_from_every_value(spark):
    rows = [("source_products", i, "f", "Plain text of value.") for i in range(9000)]
    rows += [("source_products", 9000 + i, "f", f"Word rare{chr(97 + i // 3) * 3} {'œжøłñ'[i // 3]} stands here.") for i in range(15)]
    ends = truncation.train(spark.createDataFrame(rows, "tbl string, row_id long, source string, text string"))
    # Words and characters of three values in 9,015 are counted.
    assert all("rare" + c * 3 in ends.known for c in "abcde") and "rarefff" not in ends.known
    assert set(ends.model.logs) == set("œжøłñ")


def test_the_tail_is_found_from_the_end():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choices(["a", "bc", " ", "\n", ". ", ".", "。", "  \n", "word " * 90], [8, 8, 6, 1, 1, 1, 1, 1, 1], k=rng.randint(0, 30)))
        body, at, line = text.rstrip(), 0, 0
        for m in truncation._SENTENCE_END.finditer(body):
            if m.end() < len(body):
                at = m.end()
                line = m.end() if "\n" in m.group() else line
        assert truncation._tail(text) == (body[at:], at == line)


# -- 6: near duplicates --------------------------------------------------------


def _brute(rows, width, threshold):
    from loomspan.llm.words import words

    sets = {}
    for f, i, t in rows:
        w = words(t or "")
        s = frozenset(zip(*(w[k:] for k in range(width))))
        if s:
            sets[f, i] = s
    out = set()
    for (f, i), (g, j) in itertools.combinations(sorted(sets), 2):
        a, b = sets[f, i], sets[g, j]
        if f == g and len(a & b) >= threshold * len(a | b) - 1e-9:
            out.add((f, i, j))
    return out


def expected(rows, pairs):
    """Number of pairs that the bands are expected to bring together."""
    from loomspan.llm.words import words

    sets = {i: set(zip(w, w[1:], w[2:])) for _, i, t in rows if (w := words(t or ""))}
    j = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for _, a, b in pairs]
    return sum(1 - (1 - x**neardup.ROWS) ** neardup.BANDS for x in j)


def test_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices(string.ascii_lowercase, k=4)) for _ in range(300)]
    rows, n = [], 0
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(30)]
        for _ in range(4):
            edit = list(base)
            for _ in range(rng.randint(0, 2)):
                edit[rng.randrange(30)] = rng.choice(vocabulary)
            rows.append(("f", n, " ".join(edit)))
            n += 1
    rows += [("f", 900, None), ("f", 901, ""), ("f", 902, "two words"), ("g", 903, rows[0][2]), rows[0]]
    df = spark.createDataFrame(rows, "field string, id long, text string")
    want = _brute(rows, 3, 0.7)
    got = {tuple(r) for r in neardup.similar_pairs(df, 3, 0.7).collect()}
    print("recall", len(got) / len(want))
    assert got <= want and len(got) >= expected(rows, want) - 0.01 * len(want)
    assert neardup.similar_pairs(df.limit(0), 3, 0.7).count() == 0


def test_hot_keys_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(neardup, "HOT_KEY", 4)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(30):
        edit = list(base)
        edit[rng.randrange(40)] = f"x{i}"
        rows.append(("f", i, " ".join(edit)))
    df = spark.createDataFrame(rows, "field string, id long, text string")
    assert {tuple(r) for r in neardup.similar_pairs(df, 3, 0.7).collect()} == _brute(rows, 3, 0.7)


def test_many_copies_stay_linear(spark):
    rows = [("f", i, "one and the same text of several words") for i in range(200)] + [("f", 500, "one and the same text of several words more")]
    df = spark.createDataFrame(rows, "field string, id long, text string")
    got = {tuple(r) for r in neardup.similar_pairs(df, 3, 0.7).collect()}
    assert len(got) == 200 and ("f", 0, 500) in got
    groups = neardup.similar_groups(df, 3, 0.7).collect()
    assert len(groups) == 201 and {r["group_id"] for r in groups} == {0}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101)]
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[103] == got[100] == 100


def test_packed_blocks_round_trip():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 32, 500, dtype=np.uint64))
    nodes = rng.integers(1, 1 << 62, 500, dtype=np.uint64)
    k, n = neardup._unpack(neardup._pack(keys, nodes))
    assert (k == keys).all() and (n == nodes).all()


# -- 8 and 9: packing and mixing -----------------------------------------------


def test_packing_keeps_every_token(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([3, 17, 40, 55, 70, 99, 100, 101, 260, 0])) for i in range(500)]
    sizes = spark.createDataFrame([(*r, 1, 1) for r in rows] + [(900, None, 1, 1)], "doc_id long, tokens long, capacity_tokens int, size int")
    targets = spark.createDataFrame([("a", 100, 7), ("b", 64, 7), ("none", 0, 7), (None, 50, 7), ("a", 100, 8)], "pack_name string, capacity_tokens int, tokens int")
    got = packing.packed(sizes, targets).collect()
    for name, cap in (("a", 100), ("b", 64)):
        fill, back, parts = {}, {}, {}
        for r in got:
            if r["pack_name"] == name:
                fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
                back[r["doc_id"]] = back.get(r["doc_id"], 0) + r["tokens"]
                parts[r["doc_id"]] = parts.get(r["doc_id"], 0) + 1
        assert max(fill.values()) <= cap and back == {i: n for i, n in rows if n}
        assert all(parts[i] == -(-n // cap) for i, n in rows if n)
        assert sum(fill.values()) / (cap * len(fill)) > 0.8
    assert packing.packed(sizes.limit(0), targets).count() == 0


def test_mixing_meets_shares_and_caps(spark):
    rows = [(i, "big" if i % 10 else "small", 300, 0) for i in range(2000)] + [(5000, None, 10, 0), (5001, "big", 0, 0)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, tokens long, shard int")
    targets = spark.createDataFrame([("m", "big", 0.7, 1), ("m", "small", 0.3, 3), ("empty", "nowhere", 1.0, 2), (None, "big", 1.0, 1), ("void", "big", None, 1), ("never", "big", 1.0, None)], "mix_name string, source string, target_share double, max_repeats int")
    got = mixing.mixed(sizes, targets).collect()
    total = sum(r["tokens"] for r in got)
    assert abs(sum(r["tokens"] for r in got if r["source"] == "small") / total - 0.3) < 0.01
    times: dict = {}
    for r in got:
        key = (r["source"], r["block"], r["doc_id"])
        times[key] = times.get(key, 0) + 1
    assert max(n for (s, _, _), n in times.items() if s == "big") <= 1 and max(times.values()) <= 3
    assert {r["mix_name"] for r in got} == {"m"}


def test_permutations_are_permutations():
    for n in (1, 2, 3, 7, 64, 65, 1000, 4097):
        got = mixing.permuted(np.arange(n), n, b"key")
        assert sorted(got.tolist()) == list(range(n))
        assert n < 7 or got.tolist() != mixing.permuted(np.arange(n), n, b"other").tolist()
    # Neighbours do not stay at one distance, as they would under a stride.
    assert len(set(np.diff(mixing.permuted(np.arange(1000), 1000, b"k")).tolist())) > 300


def test_chunks_draw_the_same_again():
    mix = mixing.Mix("m", ("a", "b"), (0.25, 0.75), (10, 10), (20, 20), 150_000)
    assert sum(mix.counts(c).sum() for c in range(mix.chunks)) == 150_000 and mix.chunks == 3
    assert (mix.counts(1) == mix.counts(1)).all() and mix.counts(0).shape == (mixing.CHUNK_SHARDS, 2)
    assert mixing.most_slots(0.5, 0) == 0


@pytest.mark.parametrize("capacity, low, high", [(64, 5, 64), (256, 20, 256), (2048, 90, 1500)])
def test_configurations_are_as_good_as_best_fit(capacity, low, high):
    import bisect

    rng = random.Random(capacity)
    sizes = [rng.randint(low, high) for _ in range(1500)]
    plan = packing.LargePlan(sorted({s: sizes.count(s) for s in set(sizes)}.items()), capacity)
    filled = np.bincount(plan.place(np.arange(len(sizes))), weights=sorted(sizes, reverse=True))
    rooms: list = []
    for s in sorted(sizes, reverse=True):
        at = bisect.bisect_left(rooms, s)
        bisect.insort(rooms, (rooms.pop(at) if at < len(rooms) else capacity) - s)
    assert filled.max() <= capacity and len(filled) == plan.containers
    assert plan.containers <= len(rooms) * (1.0 if len(set(sizes)) <= packing.EXACT else 1.01)


# -- 10: personal information --------------------------------------------------


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("Write to <tom.x+news @ mail.example.org> now", "email", "tom.x+news @ mail.example.org"),
        ("Mail ann [at] some [dot] example [dot] org if", "email", "ann [at] some [dot] example [dot] org"),
        ("Reach me: ann_b at some dot example dot net", "email", "ann_b at some dot example dot net"),
        ("Call +44 (0)20 7946 0260 before noon", "phone", "+44 (0)20 7946 0260"),
        ("M (933) 555-0109", "phone", "(933) 555-0109"),
        ("Rufen Sie 030/23125-992 an.", "phone", "030/23125-992"),
        ("pasted SSN 963-82-0574 into", "id_number", "963-82-0574"),
        ("Steuer-ID 92 062 984 259 into", "id_number", "92 062 984 259"),
        ("passport no. MP2137573 in", "id_number", "MP2137573"),
        ("to 809 Bramble Street, Suite 456\nQuillhaven, QX 90882.", "address", "809 Bramble Street, Suite 456\nQuillhaven, QX 90882"),
        ("at 1680 Tamsin Hollow Lane, Brenford XV58 2ZW. Removed", "address", "1680 Tamsin Hollow Lane, Brenford XV58 2ZW"),
        ("au 12 rue des Tamarins-Bleus\n99007 Saint-Verlin. Please", "address", "12 rue des Tamarins-Bleus\n99007 Saint-Verlin"),
        ("P.O. Box 309, Port Maren. Bulk", "address", "P.O. Box 309, Port Maren"),
    ],
)
def test_proposed_forms(text, kind, found):
    assert [(k, text[a:b]) for a, b, k, *_ in personal.proposals(text)] == [(kind, found)]


def test_what_is_no_personal_information():
    for text in ("Run npx mailer@6.3.5 to update", "handle @Anna_55", "Batch 538 417 7661 failed", "Serial 5856-3646-3525", "Order INV-2096-83316 shipped on 2014-09-13", "Bridge Street Analytics"):
        assert personal.proposals(text) == []


def test_only_forms_of_protected_places_disclose(spark):
    signed = "Words go here.\nRegards,\nAda Lindwick\n{}\n"
    rows = [(i, signed.format(f"(933) 555-01{i:02d}"), 0) for i in range(12)]
    rows += [(100 + i, f"Ticket 311-555-01{i:02d} is open, and so is order 21.", 0) for i in range(12)]
    rows += [(200, "Call (718) 555-0158 before noon.", 0), (201, "Mail bo@some.example now.", 0), (202, signed.format("bo@other.example"), 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, stop int")
    got = {(r["doc_id"], r["kind"], r["found_text"]) for r in personal.personal_spans(df).collect() if r["kind"] != "person"}
    assert {(200, "phone", "(718) 555-0158"), (201, "email", "bo@some.example")} <= got and len(got) == 15
    assert not any(100 <= d < 200 for d, _, _ in got)


def test_cleaning_keeps_the_rest():
    text = "Ada: +1 and x@y.example, bye"
    spans = [{"start": 5, "stop": 7, "kind": "phone"}, {"start": 12, "stop": 23, "kind": "email"}, {"start": 13, "stop": 14, "kind": "person"}]
    assert personal.replaced(text, spans)[0] == "Ada: [PHONE] and [EMAIL], bye"
    assert personal.replaced(None, spans) == (None, 0) and personal.replaced("", []) == ("", 0)


def test_names_are_learned(spark):
    rows = [(i, f"Some words here and there.\nRegards,\n{g} {f}\n", 0) for i, (g, f) in enumerate(itertools.product(["Ada", "Bela", "Cato"], ["Lindwick", "Morvosen", "Halekamp"]))]
    rows += [(50, "We met Ada Morvosen and Halekamp, Bela at the desk. Ada Planner and Bela Notes are tools. Many words here.", 0), (51, None, 0), (52, "", 0)]
    rows += [(100 + i, "Planner and Notes and words and Ada said nothing of use to anyone here today or ever.", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = {r["found_text"] for r in personal.personal_spans(df).filter("doc_id = 50 and kind = 'person'").collect()}
    assert got == {"Ada Morvosen", "Halekamp, Bela"}
    assert personal.personal_spans(df.limit(0)).count() == 0


# -- tokens --------------------------------------------------------------------


def test_vocabulary_files_agree(spark):
    from loomspan.llm import tokens

    folder = "/opt/tokenizers"
    texts = ["", "Plain words, 42 of them.", "Größe — „gut“ 5 €\n\n  indented", "<|endoftext|> is text", "日本語 и кириллица"]
    ranks, merges = (tokens.sizer(f"{folder}/byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
    assert ranks(texts) == merges(texts) and ranks(texts)[0] == 0
    assert all(n > 0 for n in tokens.sizer(f"{folder}/piece_bpe_32k.model")(texts[1:]))
    df = spark.createDataFrame([(1, "two words", "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, tokens string")
    assert {(r["doc_id"], r["tokens"]) for r in tokens.token_counts(df, ("doc_id",)).collect()} == {(1, 2), (2, 0), (3, 0)}


def test_fit_over_many_blocks_begins_near_its_end(spark, monkeypatch):
    rng = np.random.default_rng(3)
    worth = rng.normal(0, 2, 300)
    rows = []
    for _ in range(8):
        units = [sorted(rng.choice(300, 5, replace=False).tolist()) for _ in range(400)]
        label = [int(worth[u].sum() > rng.normal()) for u in units]
        rows.append(logistic.block(units, range(400), np.zeros(400), label, np.zeros(400), np.ones(400)).to_pylist()[0])
    blocks = persisted(spark.createDataFrame(rows, logistic.SCHEMA).repartition(8), "blocks")
    assert len(blocks.inputFiles()) >= 2 * logistic.BEGIN_FILES
    choose = lambda b: (b.label, np.ones(len(b.label), bool))
    one = logistic._pass
    losses: list[float] = []

    def counted(tasks, given, *rest):
        t, g = one(tasks, given, *rest)
        if given is not None:
            losses.append(t[0] / t[2])
        assert t[2] == 8 * 400  # every pass sums over all examples
        return t, g

    monkeypatch.setattr(logistic, "_pass", counted)
    with_begin = logistic.fit(blocks, choose)
    few, ended = len(losses), losses[-1]
    losses.clear()
    monkeypatch.setattr(logistic, "_beginning", lambda blocks, given, *rest: (given[3], []))
    without = logistic.fit(blocks, choose)
    assert few < len(losses) and ended < losses[-1] * 1.01
    assert np.corrcoef(with_begin[:300], without[:300])[0, 1] > 0.99


def test_lines_are_searched_together_as_one_by_one():
    lines = ["", "Page not found", "x", "n/a", "N/A.", "ERROR 404: not found", "a@b.c page not found", "see http://x/y not found 404", "page", "not found", "Null…", "Página no encontrada!", "ページが見つかりません"]
    assert messages.residue_lines(lines) == [messages.residue_line(x) for x in lines]
    assert any(messages.residue_lines(lines)) and messages.residue_lines([]) == []
    assert frames.plain_lines(["ΑΣ", "a 12 b", ""]) == ["ας", "a 0 b", ""] and frames.plain_lines([]) == []
    assert frames.line_keys(["A  1", "a 22"])[0] == frames.line_keys(["a 22"])[0]


def test_pages_note_blank_lines_headings_and_crumbs():
    known = frames.Known((np.empty(0, np.float32),) * 2, {})
    p = frames.Pages(["\na\nb\n\n c", "", "Home > Blue Lamp\nBlue lamp\nblue lamp."], [None, "http://h/x", "http://h/blue-lamp"], known)
    assert p.owner.tolist() == [0, 0, 0, 2, 2, 2] and p.number.tolist() == [1, 2, 4, 0, 1, 2]
    assert p.blank.tolist() == [True, False, True, False, False, False] and p.indent.tolist() == [0, 0, 1, 0, 0, 0]
    assert p.heading.tolist() == [-1, -1, 4] and p.crumb.tolist() == [False] * 3 + [True, False, False]


def test_placeholders_are_sought_where_they_can_begin():
    texts = ["a {{name}} b", "{{{ x }}}", "x {a} ${b}", "{{a}", "__init__ and __NAME__", "100 % @@x@@", "&lt;b&gt; text", "*|FNAME|*", "plain", "", "use {x} as placeholder. Dear {name}"]
    found = [[m.span() for m in messages._PLACEHOLDER.finditer(x)] for x in texts]
    assert all(messages.QUICK.match(x[a]) for x, spans in zip(texts, found) for a, _ in spans)
    assert [messages.unfilled(x) for x in texts] == [True, True, True, False, True, True, True, True, False, False, True]


def test_large_batches_are_held_in_portions(monkeypatch):
    texts = ["Home | Blog\nWords stand here.", None, "", "x" * 500, "y", *["Log in\nOne line more."] * 20]
    n = len(texts)
    columns = {"page_id": range(n), "text": texts, "source_url": [None] * n, "final_url": [None] * n, "host": [""] * n, "host_pages": [None] * n}
    columns |= {"title": [f"Title {i}." for i in range(n)], "description": [None] * n, "lines": [None] * n, "shares": [None] * n}
    types = {"page_id": pa.int64(), "host_pages": pa.int64(), "lines": pa.list_(pa.int64()), "shares": pa.list_(pa.float64())}
    batch = pa.RecordBatch.from_arrays([pa.array(v, types.get(c, pa.string())) for c, v in columns.items()], names=list(columns))
    whole = list(residue._scan(iter([batch])))
    monkeypatch.setattr(frames, "HELD_TEXT", 100)
    parts = list(frames.portions(batch))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and list(frames.portions(batch.slice(0, 0))) == []
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p["text"].to_pylist()) <= 100 for p in parts) and len(parts) > 4
    # One page alone may be larger; what is found is the same.
    assert sum(p.num_rows == 1 and p["text"][0].as_py() == "x" * 500 for p in parts) == 1
    assert [r for b in residue._scan(iter([batch])) for r in b.to_pylist()] == [r for b in whole for r in b.to_pylist()]
    texts = batch.filter(pa.compute.greater(pa.compute.binary_length(batch["text"]), 0))
    made = list(frames._read_pages({})(iter([texts])))
    assert len(made) > 3 and [i for b in made for i in b["page_ids"].flatten().to_pylist()] == texts["page_id"].to_pylist()
    # Blocks are handed on as they lie in memory, empty ones too.
    assert [{c: bytes(x) for c, x in r.items()} for b in made for r in frames.logistic.rows(b)] == [{c: v for c, v in r.items() if c != "page_ids"} for b in made for r in b.to_pylist()]


def test_ends_are_sought_at_the_end(monkeypatch):
    import re

    rng, seen, search = random.Random(9), [], truncation._MARK.search
    terminal = re.compile(r"[.!?。！？][\"'”’»)\]]*$")
    monkeypatch.setattr(truncation, "_MARK", type("Seen", (), {"search": staticmethod(lambda text, at=0: seen.append(text[at:]) or search(text, at))}))
    for _ in range(5000):
        text = "word " * 50 + "".join(rng.choices(["a", " ", "\n", "…", "...", ".", "-", "--", "[...]", "[…]", "(...)", "(", ")", "]", '"', "。", "?", "»"], k=rng.randint(0, 9)))
        text = text.rstrip()
        mark, whole = truncation._mark(text), search(text)
        assert (mark and mark.span()) == (whole and whole.span()) and truncation._terminal(text) == bool(terminal.search(text))
    # What is searched holds no word.
    assert seen and not any("word" in x for x in seen)
    assert truncation._mark("") is None and not truncation._terminal("") and truncation._terminal("。")
    bare = truncation.Words()
    assert [bare[x] for x in ("(word),", "word", "«word»", "...", "(word),")] == ["word", "word", "word", "", "word"] and len(bare) == 4
