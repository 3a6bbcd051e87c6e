"""Small tables with nulls, empty and long texts, repeats, extra columns; each operator against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from recspark.llm import (chat, chunk_encoding, components, divergence, extraction, histogram_packing, jaccard, outliers, packing,
                          prefix_trie, quality, rules, substrings, token_counts, vectors)
from recspark.llm.queries import BYTE_RANKS, BYTES, PIECES, WORDS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [None, "", " \n\t ", "a", BASE, BASE, BASE.replace("word30", "other"), BASE + " tail", "Ein Satz, über <b> &amp; 12!  " * 40,
         "x" * 3000, "<|endoftext|> it's </s> ###\n\n" * 5, "日本語 " * 300, "same line\n" * 30, BASE.upper(), "one two", "One  two"]
SCHEMA = "doc_id long, text string, lang string, source string, n_words string, length int, key int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", "clash", 1, None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[4], (None, BASE, "en", None, "clash", 2, 3)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < -5")


def test_token_counts(docs, empty):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
    got = token_counts.count_tokens(docs, public_tokenizers.path(PIECES), chunk=50, overlap=4, limit=30).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = (BASE if r.doc_id is None else TEXTS[r.doc_id]) or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(model.encode(text)))
        assert r.over_limit == (r.n_tokens > 30)
    assert token_counts.count_tokens(empty, public_tokenizers.path(PIECES)).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(WORDS))
    got = packing.pack(packing.token_pieces(docs, public_tokenizers.path(WORDS), capacity=64), 64).collect()
    pieces = Counter()
    for text in [*TEXTS, BASE, BASE]:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for i in range(0, len(ids), 64):
            pieces[i, zlib.crc32(np.array(ids[i:i + 64], "<u4").tobytes())] += 1
    assert Counter((r.start, r.ids_crc32) for r in got) == pieces
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for rows in bins.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(packing.token_pieces(empty, public_tokenizers.path(WORDS))).count() == 0


@pytest.mark.parametrize("top", [60, 700, 2048])
def test_two_fit_plan(top):
    lengths = np.random.default_rng(top).integers(1, top + 1, 5000)
    runs = packing.plan_bins(dict(Counter(lengths.tolist())))
    used = Counter()
    for size, _, k, bins, _, _ in runs:
        used[size] += k * bins
    assert used == Counter(lengths.tolist())
    assert max(r[4] + r[3] for r in runs) <= 1.03 * -(-lengths.sum() // 2048) + 1


def test_chat(spark):
    hard = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\0\\1\\2\\3", "#####", "</turn</turn>", "", None]
    rows = [(c, t, ["user", "assistant", "a: b", None][(c + t) % 4], hard[(c * 3 + t) % 7], 0) for c in range(9) for t in range(c + 1)]
    rows += [(3, 1, "assistant", "again", 0), (None, 0, "user", "x", 0), (None, None, "assistant", "y", 0)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example int")
    got = {r.conv_id: r for r in chat.digests(chat.format_examples(talks)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        said = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_examples(talks.where("conv_id > 99"))).count() == 0


def stats(text):
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rules(docs, empty):
    got = outliers.quality_rules(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        expected = stats((BASE if r.doc_id is None else TEXTS[r.doc_id]) or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r.kept and r.base_failed)
    assert outliers.quality_rules(empty).count() == 0
    assert set(outliers.keep_regular(docs).columns) == set(docs.columns)


def test_covariance_finds_planted_outliers(spark):
    random = np.random.default_rng(1)
    rows = [(i, "en", "a", 200, int(200 * random.normal(5, 0.1)), 0, 0, 0) for i in range(400)]
    rows += [(1000 + i, "en", "a", 200, 1000, 400, 0, 0) for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                                  "n_dup_lines long, n_repeat_words long")
    kept = {r.doc_id for r in outliers.verdict(table, outliers.fit(table)).where("kept").collect()}
    assert kept == set(range(400))


def test_covariance_finds_a_third_of_outliers(spark):
    random = np.random.default_rng(2)
    rows, regular = [], set()
    for source, symbols in (("a", 100), ("b", 200), ("c", 600), ("clean", None)):
        for i in range(400):
            outlier = symbols is not None and i < 140  # 35 percent
            regular |= set() if outlier else {len(rows)}
            rows.append((len(rows), "en", source, 200, int(200 * random.normal(5, 0.1)), symbols if outlier else int(random.integers(3)), 0, 0))
    table = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                                  "n_dup_lines long, n_repeat_words long")
    kept = {r.doc_id for r in outliers.verdict(table, outliers.fit(table)).where("kept").collect()}
    assert kept == regular


def test_extraction(spark):
    page = ("<nav><a href=x>Home</a></nav><div class='ad'>Buy it</div><article><h1>A &amp; B</h1><p><b>One\n two.<br>Three<p>Four &copy;"
            "<script>x</p></script></article><footer>(c)</footer>")
    pages = spark.createDataFrame([(1, "u", page, 0), (2, "u", None, 0), (3, None, "", 0), (4, "u", "<p>", 0), (1, "u", page, 1)],
                                  "page_id long, url string, html string, n_chars int")
    got = sorted((r.page_id, r.text, r.n_chars) for r in extraction.extract(pages).collect())
    text = "A & B\n\nOne two. Three\n\nFour ©"
    assert got == [(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "", 0)]
    rows, labels = extraction.labelled_table()
    assert (extraction.classify(extraction.grow_tree(rows, labels), rows) == labels.astype(bool)).all()


def test_quality(spark, docs, empty):
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(random.choice(words, 40)) + (" ### !!" * 5 if i % 4 == 0 else "") for i in range(400)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(table, labels)
    got = quality.classify(table, model).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    odd = quality.classify(docs, model).collect()
    assert len(odd) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in odd)
    assert quality.classify(empty, quality.train(empty, labels)).count() == 0


def test_features_do_not_depend_on_the_batch():
    texts = [t or "" for t in TEXTS]
    assert all(np.array_equal(a, quality.indicators([t])[0]) for a, t in zip(quality.indicators(texts), texts))


def test_chunk_reuse(docs, empty):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(BYTES))
    paths = public_tokenizers.path(BYTES), public_tokenizers.path(BYTE_RANKS)
    got = chunk_encoding.encode_documents(docs, *paths).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = (BASE if r.doc_id is None else TEXTS[r.doc_id]) or ""
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert chunk_encoding.encode_documents(empty, *paths).count() == 0


def test_ids_travel_in_two_bytes():
    coder = chunk_encoding.ChunkEncoder.load(public_tokenizers.path(BYTES), public_tokenizers.path(BYTE_RANKS))
    ids = np.arange(len(coder.digits))
    assert np.frombuffer(ids.astype(coder.stored).tobytes(), dtype=coder.stored).tolist() == ids.tolist()
    assert np.dtype(coder.stored).itemsize == 2


@pytest.mark.parametrize("step", [1, 7, 40])
def test_chunk_joints(step):
    coder = chunk_encoding.ChunkEncoder.load(public_tokenizers.path(BYTES), public_tokenizers.path(BYTE_RANKS))
    for text in filter(None, TEXTS):
        text = text[:600]
        parts = [text[i:i + step] for i in range(0, len(text), step)]
        joined = coder.join([p.encode() for p in parts], [coder.ids(p) for p in parts])
        assert joined.tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def classes(pairs, nodes):
    root = {i: i for i in nodes}
    for _ in nodes:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("n,percent,budget", [(3, 90, 400_000), (3, 90, 100), (5, 80, 400_000)])
def test_jaccard(spark, docs, empty, n, percent, budget):
    random = np.random.default_rng(n)
    base = [f"w{i}" for i in range(120)]
    more = {100 + i: " ".join(w if random.random() > 0.01 else "edit" for w in base) for i in range(30)}
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    sets = {}
    for i, t in [*enumerate(TEXTS), *more.items()]:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = classes(pairs, sets)
    for r in jaccard.jaccard_components(table, n=n, percent=percent, budget=budget).collect():
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
    assert jaccard.jaccard_components(empty).count() == 0


def test_sets_of_few_documents_at_once():
    frame = pd.DataFrame({"id": [str(i) for i in range(2 * jaccard.ROWS + 5)]})
    parts = list(jaccard._slices(iter([frame, frame.head(3)])))
    assert [len(p) for p in parts] == [jaccard.ROWS, jaccard.ROWS, 5, 3]
    assert pd.concat(parts)["id"].tolist() == frame["id"].tolist() + frame["id"].tolist()[:3]


@pytest.mark.parametrize("budget,spare_share", [(400_000, 0.5), (1_500, 0.5), (1_500, 1 / 16)])
def test_jaccard_of_chains_beside_a_common_passage(spark, budget, spare_share):
    """Chains whose ends are far apart, groups around the threshold and a passage that all documents share."""
    random = np.random.default_rng(11)
    passage = [f"common{i}" for i in range(60)]
    texts, i = {}, 0
    for chain in range(6):
        words = [f"c{chain}x{k}" for k in range(140)]
        for step in range(9):
            texts[i] = " ".join(passage + words)
            at = int(random.integers(0, len(words) - 30))
            words = [*words[:at], *(f"n{i}x{k}" for k in range(4 + 5 * chain)), *words[at + 4 + 5 * chain:]]
            i += 1
    for other in range(40):
        texts[i] = " ".join([f"o{other}x{k}" for k in range(int(random.integers(60, 240)))] + passage)
        i += 1
    sets = {}
    for i, t in texts.items():
        w = t.split(" ")
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    pairs = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = classes(pairs, sets)
    assert 46 < len(set(root.values())) < 90
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = jaccard.jaccard_components(table, n=5, percent=80, budget=budget, spare_share=spare_share).collect()
    assert {r.doc_id: r.component_id for r in found} == root


def test_part_keys_keep_a_rare_shared_key():
    """Whatever the order of frequency, each pair over the threshold keeps a common key after both drop theirs."""
    random = np.random.default_rng(3)
    tops = jaccard._class_tops(0.8, 1 << 20)
    for trial in range(300):
        size = int(random.integers(5, 400))
        x = np.unique(random.integers(0, 1 << 62, size, dtype=np.uint64))
        common = x[: int(np.ceil(len(x) * random.uniform(0.89, 1)))]
        y = np.unique(np.concatenate([common, random.integers(0, 1 << 62, len(x) - len(common), dtype=np.uint64)]))
        if 100 * len(common) < 80 * len(np.union1d(x, y)):
            continue
        kept = []
        for s in (x, y):
            keys = set()
            for own, drop in jaccard.part_keys(s, 80, tops, 0.5):
                keys |= set(sorted(own.tolist(), key=lambda k: k * (2 * trial + 1) % 1_000_003)[drop:])
            kept.append(keys)
        assert kept[0] & kept[1]


def test_substrings(docs, empty):
    seen, expected = {}, {}
    for i, t in enumerate(TEXTS):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if seen.setdefault(tuple(w[k:k + 13]), i) < i:
                gone[k:k + 13] = [True] * 13
        expected[i] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    got = substrings.remove_repeats(docs, keep=("lang",))
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert (r.n_words, r.n_removed, r.kept_text) == (expected[r.doc_id] if r.doc_id is not None else (60, 0, BASE))
    assert substrings.remove_repeats(empty).count() == 0


def test_false_hits_of_a_full_bitmap_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MOST_BITS", 16)
    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(400)]
    texts[300] = texts[300] + " " + texts[20]
    written, before = {}, substrings.stored

    def watched(df, name):
        written[name] = before(df, name)
        return written[name]

    monkeypatch.setattr(substrings, "stored", watched)
    rows = substrings.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in rows if r.n_removed} == {(300, 100)}
    # the blocks fill a quarter of the bitmap: some hundred documents are hit by chance
    assert {r.id for r in written["held"].collect()} >= {20, 300} and written["held"].count() < 20


def test_vectors(spark):
    random = np.random.default_rng(5)
    centres = random.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.15 * random.standard_normal(16)).tolist(), 0) for i in range(200)]
    rows += [(300, rows[0][1], 0), (301, [2 * x for x in rows[0][1]], 0), (302, None, 0), (303, [0.0] * 16, 0), (304, [float("nan")] * 16, 0),
             (305, [1.0, None], 0), (306, [], 0), (307, [1.0], 0), (308, [3.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    good = {i: np.array(v) for i, v, _ in rows if i not in (302, 303, 304, 305, 306)}
    pairs = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    links, root = Counter(x for p in pairs for x in p), classes(pairs, [r[0] for r in rows])
    got = {r.vec_id: r for r in vectors.near_duplicates(table, recall=0.9999).collect()}
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(links.values())
    for i, r in got.items():
        assert r.n_links <= links[i] and r.kept == (r.component_id == i)
    assert all(got[i].component_id == root[i] for i in (0, 300, 301, 302, 303, 304, 305, 306, 307, 308))
    assert vectors.near_duplicates(table.where("vec_id < 0")).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 50)] + [(100, 7), (5, 5), (None, 3), (200, 201), (201, 200)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in [*range(51), 100]}, 200: 200, 201: 200}


def test_near_duplicates_are_rows(spark):
    import corpus_pipeline
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(60)) for name in "abcd")
    rows = [(1, a), (1, a), (3, b), (5, b + " tail"), (5, c), (None, d), (None, d), (None, a), (7, d + " tail"), (8, "short"), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), "")
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(
        [(1, a), (3, b), (5, c), (7, d + " tail"), (8, "short"), (9, None)])


def test_pipeline(spark, sf):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        before = spark.createDataFrame(after.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert packed.select("doc_id").distinct().count() == before.count()
    kept = {r.doc_id for r in before.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    junk = [i for i in kept if labels.get(i) == 0]
    assert len(junk) <= 2


def plain_trie(rows):
    """Nodes of the rebuilt conversations by brute force."""
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            item = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own.setdefault(c, []).append((t is not None, t or 0, role or "", item, text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns, key=lambda t: t[:4])] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members, kids, leaves, saved = {}, Counter(), Counter(), Counter()
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for p in members:
        kids[p[:-1]] += p != ()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    nodes = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        nodes[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return nodes


def test_prefix_trie(spark):
    random = np.random.default_rng(11)
    texts, roles = ["a", "bb", None, "", "x" * 5000, "日本"], ["user", "assistant", None, ""]
    rows = [(c, None if random.random() < 0.2 else t, roles[random.integers(4)], texts[random.integers(6)])
            for c in [*range(-4, 24), 100, 101, 107, 250, 1 << 40, None] for t in range(int(random.choice([1, 1, 2, 3, 5, 8, 17])))]
    rows += [(100, 1, "user", "same")] * 3 + [(c, t, "user", "hot") for c in range(600, 640) for t in range(4)]  # repeated rows, equal conversations
    rows += [(700, t, "user", str(t % 3)) for t in range(150)] + [(701, t, "user", str(t % 3)) for t in range(149)]
    schema = "conv_id long, turn long, role string, text string"
    talks = spark.createDataFrame([(*r, 0, "x") for r in rows], schema + ", depth int, n_convs string").repartition(5)
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(talks).collect()) == plain_trie(rows)
    # no turn is left after the exchange of first turns: only the root
    lone = spark.createDataFrame([(c, 0, "user", "x") for c in (1001, 1002)], schema)
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(lone).collect()) == plain_trie([tuple(r) for r in lone.collect()])
    assert prefix_trie.prefix_trie(talks.where("conv_id < -1000")).count() == 0
    assert prefix_trie.prefix_trie(talks.where("conv_id is null")).count() == 0


def check_sequences(rows, capacity):
    """Gapless, disjoint, and padded nowhere: full or of the size of a power of two."""
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity and end & (end - 1) == 0 or end == capacity
    return bins


@pytest.mark.parametrize("capacity", [32, 100, 1024])
def test_histogram_packing(docs, empty, capacity):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(BYTES))
    paths = public_tokenizers.path(BYTES), public_tokenizers.path(BYTE_RANKS)
    table = docs.withColumn("offset", docs.length)
    got = histogram_packing.pack_documents(table, *paths, capacity=capacity).collect()
    expected = Counter()
    for i, text in [*enumerate(TEXTS), (4, BASE), (None, BASE)]:
        expected[i, (*tokenizer.encode(text or "", add_special_tokens=False).ids, 0)] += 1
    check_sequences(got, capacity)
    whole = Counter()
    for (i, ids), n in expected.items():
        parts = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
        assert all(r.doc_tokens == len(ids) for r in got if r.doc_id == i)
        assert sum(p[1] for p in parts) == n * len(ids)
        for start, length, crc in parts:
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
        for start, length, _ in parts:
            whole.update((i, t) for t in range(start, start + length))
        assert all(whole[i, t] == n for t in range(len(ids)))  # each id once for each document
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // capacity) + capacity.bit_length()
    assert histogram_packing.pack_documents(empty, *paths).count() == 0


@pytest.mark.parametrize("low,high", [(1, 1024), (600, 1000), (1, 40), (700, 700), (1024, 1024)])
def test_pack_plan(low, high):
    lengths = np.random.default_rng(low).integers(low, high + 1, 4000)
    counts = Counter(lengths.tolist())
    placement = histogram_packing.Placement(histogram_packing.plan_packs(dict(counts)))
    length = np.concatenate([np.full(n, size) for size, n in counts.items()])
    owner, skip, tokens, sequence, offset = placement.find(length, np.concatenate([np.arange(n) for n in counts.values()]))
    assert np.array_equal(np.bincount(owner, weights=tokens).astype(int), length)
    assert np.array_equal(skip, [0 if i == 0 or owner[i] != owner[i - 1] else skip[i - 1] + tokens[i - 1] for i in range(len(owner))])
    used = np.bincount(sequence, weights=tokens).astype(int)
    assert all(u == 1024 or u & (u - 1) == 0 for u in used) and (used < 1024).sum() <= 10
    assert sum(offset + tokens == used[sequence]) == len(used)
    assert len(placement.parts) < 6000  # the plan follows the histogram


def plain_divergence(rows, min_docs, top):
    docs, said, sources = Counter(), {}, {}
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        docs.update((lang or "", w) for w in set(words))
        sources.setdefault(lang or "", set()).add(source or "")
        said.setdefault((lang or "", source or ""), Counter()).update(words)
    found = Counter()
    for lang, own in sources.items():
        kept = [w for (x, w), n in docs.items() if x == lang and n >= min_docs]

        def rates(c):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10 ** 9 * (c[w] + 5) // (total + 5 * len(kept)) for w in kept}
        rate, base = {s: rates(said[lang, s]) for s in own}, rates(sum((said[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(-sum(abs(rate[s][w] - rate[o][w]) for w in kept), o.encode(), o) for o in own if o != s]
            terms = [(base[w] - rate[s][w], w.encode(), w) for w in kept if said[lang, s][w] and rate[s][w] > base[w]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found.update((lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(items))
    return found


@pytest.mark.parametrize("shard_terms,round_bytes,block_sources", [(8192, 10 ** 7, 64), (4, 500, 2)])
def test_divergence(spark, shard_terms, round_bytes, block_sources):
    random = np.random.default_rng(13)
    words = ["Alpha", "béta", "ÉTÉ", "日本", "x1y", "tail", "it's", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(" ".join(random.choice(words, random.integers(0, 30))), ["en", "de", None, ""][random.integers(4)],
             ["a", "b", None, "ß", "src"][random.integers(5)]) for _ in range(160)]
    rows += [(None, "en", "none"), ("", "xx", "p"), ("!! 12", "xx", "q"), ("rare", "yy", "only"), ("alpha " * 100_000, "de", "long")] + [rows[0]] * 5
    table = spark.createDataFrame([(*r, 0, "x") for r in rows], "text string, lang string, source string, item int, rank string").repartition(4)
    got = divergence.audit(table, min_docs=8, top=6, shard_terms=shard_terms, round_bytes=round_bytes, block_sources=block_sources)
    assert Counter(tuple(r) for r in got.collect()) == plain_divergence(rows, 8, 6)
    assert divergence.audit(table.where("lang = 'zz'")).count() == 0


def test_divergence_sums_pairs_over_shards_in_any_order(spark):
    random = np.random.default_rng(14)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    rows = [(" ".join(random.choice(words, 40)), "en", f"s{random.integers(12)}") for _ in range(300)]
    rows += [(f"{a} " * 9, "nul\0" + x, "src\0" + y) for a, x, y in zip(words, "ab" * 20, "ccdd" * 10)] * 3
    table = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    got = divergence.audit(table, min_docs=3, top=6, shard_terms=3, round_bytes=20_000, block_sources=5)
    assert Counter(tuple(r) for r in got.collect()) == plain_divergence(rows, 3, 6)


def test_perfect_hash(monkeypatch):
    terms = [f"term{i}".encode() for i in range(5000)]
    asked = [*terms, *(f"other{i}".encode() for i in range(5000))]
    table = divergence.PerfectHash.build(terms)
    slots = table.slots(divergence.hashes_of(asked), asked)
    assert sorted(slots[:5000]) == list(range(5000)) and (slots[5000:] == -1).all()
    assert all(table.terms[s] == t for s, t in zip(slots, terms))
    # terms of one hash find no level of their own
    monkeypatch.setattr(divergence, "hashes_of", lambda terms: np.zeros(len(terms), dtype=np.uint64))
    table = divergence.PerfectHash.build(terms[:50])
    slots = table.slots(divergence.hashes_of(asked[:60]), asked[:60])
    assert sorted(slots[:50]) == list(range(50)) and (slots[50:] == -1).all()


def test_rates_are_exact():
    for n, total, v in [(0, 0, 1), (7, 9, 3), (10 ** 13, 10 ** 13, 10 ** 6), (9_223_372_037, 99_999_999_999_999, 12_345)]:
        assert divergence.rates(np.array([n]), np.int64(total), np.int64(v))[0] == 1 + 10 ** 9 * (n + 5) // (total + 5 * v)


def test_rules_count_their_groups_once_a_fit(spark, monkeypatch):
    counted, few = [], outliers._few
    monkeypatch.setattr(outliers, "_few", lambda groups: counted.append(1) or few(groups))
    rows = [(i, "en", f"s{i % 2}", 100, 500 + i % 7, i % 3, 0, i % 5) for i in range(200)]
    stats = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long,"
                                        " n_dup_lines long, n_repeat_words long")
    outliers.fit(stats)
    assert len(counted) == 1


def test_descent_keeps_no_second_copy_of_its_rows():
    import tracemalloc
    random = np.random.default_rng(3)
    rows = [np.sort(random.choice(4096, 2000, replace=False)).astype(np.int32) for _ in range(300)]
    y, ratios = np.where(random.random(300) < 0.5, 1.0, -1.0), random.normal(size=4096)
    tracemalloc.start()
    try:
        quality.dual_coordinate_descent(rows, y, ratios, np.ones(300), epochs=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < sum(r.nbytes for r in rows) / 2
