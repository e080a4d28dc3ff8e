"""Line templates, token files, language identification, PPM and quality rules against plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import lettered, no_docs, odd_docs, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepforge.llm import arrays, language_id, line_quality, line_templates, ppm, queries, token_files

SF = "/root/testdata/sf0.001"


# words and hashes

@settings(deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té漢", max_size=30), min_size=1, max_size=8))
def test_words_of_a_slice_are_those_of_each_text(texts):
    offsets, data = arrays.utf8(pa.array(["skipped", *texts], pa.string()).slice(1))
    found = arrays.Words(offsets, data)
    spelled = [data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
    per_text = [spelled[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
    assert per_text == [words(t) for t in texts]
    same = defaultdict(set)
    for w, h in zip(spelled, found.hashes().tolist()):
        same[w].add(h)
    assert all(len(x) == 1 for x in same.values()) and len({h for x in same.values() for h in x}) == len(same)


# op1

def plain_templates(docs, min_docs):
    """Dropped line numbers per (doc_id, text), with every two lines of a leaf compared, and the spelled templates."""
    lines = defaultdict(list)  # (size, leading words) -> [(doc_id, text, number, masked words)]
    for doc_id, text in {(d, t) for d, t in docs if t}:
        for number, line in enumerate(text.split("\n")):
            masked = ["<*>" if re.search("[0-9@]|://", w) else w for w in words(line)]
            if masked:
                lines[len(masked), *masked[: line_templates.DEPTH]].append((doc_id, text, number, masked))
    dropped, spelled = defaultdict(set), set()
    for leaf, rows in lines.items():
        left = list(rows)
        while left:
            group = [left.pop()]
            for row in group:
                near = [r for r in left if 100 * sum(map(str.__eq__, row[3], r[3])) >= line_templates.SIMILAR * leaf[0]]
                left = [r for r in left if r not in near]
                group += near
            ids = {r[0] for r in group}
            if len(ids) >= (line_templates.LONG_DOCS if leaf[0] > line_templates.LONG_WORDS else min_docs):
                spelled.add(" ".join(w[0] if len(set(w)) == 1 else "<*>" for w in zip(*(r[3] for r in group))))
                keeper = min(i for i in ids if i is not None) if ids != {None} else None
                for doc_id, text, number, _ in group:
                    if doc_id != keeper or keeper is None:
                        dropped[doc_id, text].add(number)
    return dropped, spelled


def near_lines(seed, n_docs, width):
    """Documents of lines that are changed copies of a few: in one leaf, in leaves of few free words, long, with fields."""
    draw = random.Random(seed)
    base = [[*lettered(1, 4), *lettered(2 + k % 2, width + (k % 3))] for k in range(5)] + [lettered(9, 60), lettered(10, 5)]
    out = []
    for i in range(n_docs):
        texts = []
        for _ in range(draw.randint(1, 3)):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, len(line) // 2)):
                line[draw.randrange(4 if len(line) < 60 else 0, len(line))] = draw.choice(["x", "y", "n7", "a@b", *lettered(4, 20)])
            texts.append(" ".join(line))
        out.append((None if i % 17 == 5 else i // 2 * 2 if i % 19 == 7 else i, "\n".join(texts)))
    return out


@pytest.mark.parametrize("rows, share", [(8_192, 500_000), (7, 500_000), (1, 200)])
def test_templates_equal_all_pairs_for_any_block(spark, monkeypatch, rows, share):
    monkeypatch.setattr(line_templates, "BLOCK_ROWS", rows)
    monkeypatch.setattr(line_templates, "BLOCK_WORDS", share)
    docs = near_lines(3, 120, 9)
    judged, templates = line_templates.recurring(spark.createDataFrame(docs, "doc_id long, text string"), min_docs=3)
    dropped, spelled = plain_templates(docs, 3)
    keys = {r["key"]: (r["doc_id"], r["text"]) for r in spark.createDataFrame(docs, "doc_id long, text string").withColumn(
        "key", F.struct("doc_id", F.xxhash64("text").alias("text_key"))).collect()}
    got = {keys[r["doc_id"], r["text_key"]]: set(r["dropped"]) for r in judged.collect()}
    assert {k: v for k, v in got.items() if v} == dict(dropped)
    assert {r["spelled"] for r in templates.collect()} == spelled and any("<*>" in x for x in spelled)


def test_a_chain_of_similar_lines_is_one_template(spark, monkeypatch):
    monkeypatch.setattr(line_templates, "BLOCK_ROWS", 8)
    base, other = lettered(11, 60), lettered(12, 60)
    chain = [" ".join(other[:k] + base[k:40]) for k in range(4, 40)]
    chain = [" ".join(["one", "two", "three", "four", *x.split()]) for x in chain]
    docs = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    assert [r["n_dropped"] for r in line_templates.clean(docs).orderBy("doc_id").collect()] == [0] + [1] * 35


def test_lines_linked_by_steps_have_one_first_line():
    table = np.array([[1, 2, 3, 4, 5], [1, 2, 3, 9, 9], [8, 2, 9, 9, 9], [8, 8, 9, 9, 9], [7, 7, 7, 7, 7]], np.int32)
    assert line_templates.linked(table).tolist() == [0, 0, 0, 0, 4]


def test_recurring_templates_are_dropped(spark):
    own = lambda i: " ".join(lettered(100 + i, 12))
    rows = [(i, f"{own(i)}\nPage {i} of the great printed archive copy", "x") for i in range(12)]
    rows += [(20, f"{own(20)}\nseen twice only by us", "x"), (21, f"{own(21)}\nseen twice only by us", "x")]
    got = {r["doc_id"]: r for r in line_templates.clean(spark.createDataFrame(rows, "doc_id long, text string, n string")).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_dropped"] == 0
    assert all(got[i]["text"] == own(i) and got[i]["n_dropped"] == 1 for i in range(1, 12))
    assert got[20]["text"] == rows[12][1] and got[21]["n_dropped"] == 0 and got[21]["n"] == "x"


def test_variable_words_recur_as_one_template(spark):
    names = lettered(5, 15)
    rows = [(i, f"dear reader and friend {n} we greet you all") for i, n in enumerate(names)]
    got = line_templates.clean(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["n_dropped"] for r in got.collect()) == [0] + [1] * 14


def test_long_lines_recur_from_two_documents_on(spark):
    own = lambda i: " ".join(lettered(100 + i, 12))
    passage = " ".join([*lettered(7, 58), "in", "2024"])
    other = passage.replace("2024", "1999")  # the same but for a field
    short = " ".join(lettered(8, 50))
    rows = [(1, f"{own(1)}\n{passage}\n{short}"), (2, f"{passage}\n{own(2)}\n{short}"), (3, f"{own(3)}\n{other}"), (None, passage)]
    got = {r["doc_id"]: r for r in line_templates.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == rows[0][1] and got[3]["text"] == own(3)
    assert got[2]["text"] == f"{own(2)}\n{short}" and got[2]["n_dropped"] == 1
    assert got[None]["text"] == "" and got[None]["n_dropped"] == 1


def test_similar_lines_of_a_large_leaf_meet(spark, monkeypatch):
    monkeypatch.setattr(line_templates, "BLOCK_ROWS", 8)
    lead, base = "log of the day", lettered(3, 8)
    varied = [" ".join([lead, *(f"x{'abcdefghijkl'[i]}" if k == i % 3 else w for k, w in enumerate(base))]) for i in range(12)]
    rows = list(enumerate(varied)) + [(100 + i, f"{lead} {' '.join(lettered(20 + i, 8))}") for i in range(60)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(0 < i < 12) for i, _ in rows}


def test_line_templates_on_odd_rows(spark):
    got = line_templates.clean(odd_docs(spark), min_docs=3)
    assert got.columns == [*odd_docs(spark).columns, "n_lines", "n_dropped"]
    assert got.count() >= len(odd_rows()) - 1
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[2]["text"] is None and by_id[4]["text"] == " \n\t "
    assert by_id[1]["n_dropped"] == 0 and by_id[7]["n_dropped"] == 1  # one text in documents 1, 7 and 8
    assert line_templates.clean(no_docs(spark)).count() == 0


# op2

@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1)))
def test_values_round_trip(values):
    control, data = token_files.encode_values(np.array(values, np.uint32))
    assert token_files.decode_values(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


@settings(deadline=None)
@given(st.lists(st.integers(0, 70_000)))
def test_files_round_trip_and_notice_damage(ids):
    file = token_files.pack(np.array(ids, np.int64))
    assert token_files.unpack(file).tolist() == ids
    with pytest.raises(ValueError):
        token_files.unpack(file + b"x")


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return [e.ids + [token_files.END_ID] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(deadline=None)
@given(st.lists(st.text(alphabet="aZé ÉßΣ'sdt.,$<|>endoftx\n̈İ\x85\x1c1²", max_size=40), min_size=1, max_size=5))
def test_encoding_word_by_word_equals_the_library(texts):
    ids, counts = token_files.encoder(queries.tokenizer_path()).ids(pa.array(texts))
    cuts = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [x[:-1] for x in plain_ids(texts)]


def test_token_files_on_odd_rows(spark):
    got = token_files.read_index(token_files.write(odd_docs(spark), queries.tokenizer_path())).orderBy("start").collect()
    rows = odd_rows()
    expected = Counter()
    for (doc_id, *_), ids in zip(rows, plain_ids([r[1] for r in rows])):
        expected[(doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    starts = np.cumsum([0] + [r["n_tokens"] for r in got])[:-1]
    assert [r["start"] for r in got] == starts.tolist()
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys)
    assert token_files.read_index(token_files.write(no_docs(spark), queries.tokenizer_path())).count() == 0


# op3

def test_languages_are_told_apart_on_held_out_documents(spark):
    got = queries.QUERIES["op3_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id").where("lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held) > 0


def test_posteriors_equal_a_plain_naive_bayes(spark):
    texts = [("en", "the cat sat, the mat"), ("en", "that hat"), ("de", "die Katze saß"), ("fr", "le chat é")]
    model = language_id.learn(spark.createDataFrame([(t, lang) for lang, t in texts], "text string, lang string"))

    def grams(text):
        letters, out = "", []
        for c in text:
            letters += c.lower() if c.isalpha() else ("" if letters[-1:] in ("", " ") else " ")
        for n in (1, 2, 3):
            for i in range(len(letters) - n + 1):
                g = letters[i : i + n]
                if g.strip():
                    out.append(g)
        return out

    counts = defaultdict(Counter)
    for lang, t in texts:
        counts[lang].update(grams(t))
    test = "the chat sat"
    total = {}
    for lang in sorted(counts):
        n = sum(counts[lang].values()) + language_id.SMOOTHING * language_id.BUCKETS
        prior = math.log(sum(x == lang for x, _ in texts) / len(texts))
        total[lang] = prior + sum(math.log((counts[lang][g] + language_id.SMOOTHING) / n) for g in grams(test))
    best = max(total, key=total.get)
    share = 1 / sum(math.exp(v - total[best]) for v in total.values())
    langs, scores = language_id.posteriors(model, pa.array([test, None, "12 !"]))
    assert model.langs[langs[0]] == best and abs(scores[0] - share) < 1e-4
    assert langs[1:].tolist() == [-1, -1] and scores[1:].tolist() == [0, 0]


def test_language_id_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = language_id.predict(docs, language_id.learn(docs), ("doc_id", "n_words")).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(odd_rows()) and by_id[2]["lang_pred"] == by_id[4]["lang_pred"] == "und"
    assert all(0 <= r["score"] <= 1 for r in got)
    unlearned = language_id.predict(docs, language_id.learn(no_docs(spark))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}
    assert language_id.predict(no_docs(spark), language_id.learn(docs)).count() == 0


# op4

def plain_ppm(train, order):
    node = defaultdict(Counter)
    for text in train:
        data = b"\n" * order + (" ".join(words(text)) + "\n").encode()
        for p in range(order, len(data)):
            for k in range(order + 1):
                node[data[p - k : p]][data[p]] += 1

    def log(context, symbol):
        total, gone = 0.0, set()
        for k in range(order, -1, -1):
            own = {s: c for s, c in node.get(context[order - k :], {}).items() if s not in gone}
            if own:
                n = sum(own.values())
                if symbol in own:
                    return total + math.log10((own[symbol] - 0.5) / n)
                total += math.log10(0.5 * len(own) / n)
                gone |= set(own)
        return total - math.log10(256 - len(gone))

    def score(text):
        data = b"\n" * order + (" ".join(words(text)) + "\n").encode()
        return sum(log(data[p - order : p], data[p]) for p in range(order, len(data)))

    return score


@pytest.mark.parametrize("frequent", [500_000, 5])
def test_scores_equal_plain_ppm_and_unigrams(spark, frequent):
    random.seed(3)
    pool = ["the", "then", "cat", "cats", "émigré", "dog", "a"]
    rows = [(i, i % 3 == 0, " ".join(random.choices(pool + [f"x{i}"], k=12))) for i in range(30)]
    rows += [(40, True, None), (41, True, "unseen ZEBRA\n\tthe"), (None, True, "")]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    learned = ppm.learn(docs.where("NOT held_out"), order=3, broadcast_words=frequent)
    train = [t for _, held, t in rows if not held]
    counts = Counter(w for t in train for w in words(t))
    everything, distinct = sum(counts.values()) + len(train), len(counts) + 1
    plain = plain_ppm(train, 3)
    got = {r["doc_id"]: r for r in ppm.score(docs, learned).collect()}
    assert len(got) == len(rows)
    for doc_id, held, text in rows:
        r, own = got[doc_id], words(text)
        base = sum(math.log10((counts[w] + 1) / (everything + distinct + 1)) for w in own)
        base += math.log10((len(train) + 1) / (everything + distinct + 1))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own) + 1, sum(w in counts for w in own) + 1, everything)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], plain(text), rel_tol=1e-9)


def test_ppm_probabilities_sum_to_one(spark):
    learned = ppm.learn(spark.createDataFrame([("abracadabra abra",), ("cad brac",)], "text string"), order=2)
    for context in (b"ab", b"zz", b"\n\n", b"a "):
        keys = np.array([context[0] << 16 | context[1] << 8 | s for s in range(256)], np.uint64)
        assert abs((10 ** learned.trie.logs(keys)).sum() - 1) < 1e-9


def test_ppm_without_training_and_on_odd_rows(spark):
    docs = odd_docs(spark).withColumn("held_out", F.lit(True))
    got = {r["doc_id"]: r for r in ppm.score(docs, ppm.learn(no_docs(spark))).collect()}
    assert math.isclose(got[3]["score"], -math.log10(256)) and got[3]["n_known"] == 0 and got[3]["base_score"] == 0
    learned = ppm.learn(odd_docs(spark))
    assert ppm.score(docs, learned).count() == len(odd_rows())
    assert ppm.score(docs.limit(0), learned).count() == 0


def test_capacity_keeps_the_most_frequent_entries(spark):
    rows = [(f"common words {w}",) for w in lettered(9, 50)]
    learned = ppm.learn(spark.createDataFrame(rows, "text string"), order=2, max_entries=60)
    assert 0 < sum(len(k) for k in learned.trie.keys) <= 60
    assert np.isfinite(learned.trie.logs(np.arange(256, dtype=np.uint64))).all()


@pytest.mark.parametrize("most", [0, 60, 300])
def test_entries_beyond_the_broadcast_count_as_well(spark, most):
    rows = [(i, i % 3 == 0, " ".join(lettered(i % 7, 4) + ["common", "émigré"] + lettered(200 + i, 3))) for i in range(30)]
    rows += [(40, True, None), (41, True, "unseen ZEBRA common")]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    learned = ppm.learn(docs.where("NOT held_out"), order=4, max_entries=most)
    assert learned.longest is not None and sum(len(k) for k in learned.trie.keys) <= most
    plain = plain_ppm([t for _, held, t in rows if not held], 4)
    got = {r["doc_id"]: r["score"] for r in ppm.score(docs, learned).collect()}
    assert all(math.isclose(got[i], plain(t), rel_tol=1e-9) for i, _, t in rows) and len(got) == len(rows)


# op9

def plain_quality(rows, max_line_docs):
    held = defaultdict(set)
    for doc_id, text, host in rows:
        for line in (text or "").split("\n"):
            if words(line):
                held[(host, tuple(words(line)))].add(doc_id)
    out = {}
    for doc_id, text, host in rows:
        text = text or ""
        own = words(text, lower=False)
        windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
        covered = {i + k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(5)}
        seen, doubles, removed = set(), 0, 0
        for line in text.split("\n"):
            if words(line):
                doubles += line in seen
                seen.add(line)
                docs = held[(host, tuple(words(line)))]
                removed += len(words(line)) * (len(docs) > max_line_docs and doc_id != min(docs))
        failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
        left = len(own) - removed
        out[doc_id] = (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), doubles, len(covered), failed,
                       not failed and left >= 10 and left >= 0.5 * len(own))
    return out


def test_quality_rules_equal_plain_python(spark):
    rows = [(i, f"{' '.join(lettered(i, 15))}\nCookie  notice #1 é\n<b>", "h1" if i % 2 else "h2") for i in range(24)]
    rows += [(30 + i, "ALL the lines are the same in these here documents\nand NO line of them is only theirs", "h1") for i in range(8)]
    rows += [(50, "a b c d e " * 6, "h1"), (51, "x\nx\n \n\nx", None), (52, None, "h1"), (53, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {
        r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"])
        for r in line_quality.judge(docs, max_line_docs=5).collect()
    }
    assert got == plain_quality(rows, 5)
    assert got[30][-1] and not got[31][-1]
    cleaned = {r["doc_id"]: r["text"] for r in line_quality.clean(docs, max_line_docs=5).collect()}
    assert set(cleaned) == {i for i, x in got.items() if x[-1]}
    assert "Cookie" in cleaned[1] and cleaned[3] == " ".join(lettered(3, 15)) and cleaned[30] == rows[24][1]


def test_boilerplate_of_a_small_host_is_removed(spark):
    same = "\n".join(" ".join(lettered(k, 12)) for k in (1, 2, 3))
    rows = [(i, same, "small") for i in range(60)]
    rows += [(100 + i, f"{' '.join(lettered(10 + i, 20))}\nheld by a few only", "other") for i in range(5)]
    rows += [(200 + i, f"{' '.join(lettered(50 + i, 20))}\nheld by more than a few", None) for i in range(6)]
    got = {r["doc_id"]: (r["kept"], r["n_removed_words"]) for r in line_quality.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == (True, 0) and all(got[i] == (False, 36) for i in range(1, 60))
    assert all(got[100 + i] == (True, 0) for i in range(5))
    assert got[200] == (True, 0) and all(got[200 + i] == (True, 6) for i in range(1, 6))


def test_quality_rules_on_odd_rows(spark):
    got = line_quality.judge(odd_docs(spark)).collect()
    assert len(got) == len(odd_rows())
    kept = line_quality.clean(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and {r["doc_id"] for r in kept.collect()} == {1, None, 5, 7, 9}
    assert kept.where("doc_id = 1").count() == 2
    assert line_quality.judge(no_docs(spark)).count() == line_quality.clean(no_docs(spark)).count() == 0
