import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from corpusloom.llm import components, decontaminate, fuzzy_lines, language_id, license_scan, pii_crf, quality_mcd, token_shards

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# token shards


def test_shards_read_back_what_the_library_gives(spark):
    from tokenizers import Tokenizer

    rows = [(3, "Hello, WORLD it's\n\ta"), (1, None), (2, ""), (None, "a b"), (5, "É x \x1c y " * 50), (5, "ties")]
    got = token_shards.read_shards(token_shards.write_shards(frame(spark, rows), TOKENIZER, 2)).collect()
    lib, start = Tokenizer.from_file(TOKENIZER), 0
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 5, 5]
    for r in got:
        texts = [lib.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows if i == r.doc_id]
        assert list(r.ids) in texts and r.start == start and r.n_tokens == len(r.ids)
        start += len(r.ids)
    digest = token_shards.read_shards(token_shards.write_shards(frame(spark, rows), TOKENIZER, 2), digest=True).collect()
    assert {r.start: r.ids_crc32 for r in digest} == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_one_document_is_read_alone_and_the_dictionary_is_checked(spark, tmp_path):
    rows = [(i, f"text number {i}") for i in range(40)]
    path = token_shards.write_shards(frame(spark, rows), TOKENIZER, 2, f"file://{tmp_path}/s").first().path
    shard = token_shards.Shard(path)
    assert shard.doc_ids[17] == 17 and shard.ids(17)[-1] == 2
    next((tmp_path / "s").glob("*.zdict")).write_bytes(b"other")
    with pytest.raises(ValueError):
        token_shards.Shard(path)


# language identification


def test_language_accuracy_and_rejection(spark):
    rng = random.Random(1)
    stems = {"xx": "ka to mi ra su no".split(), "yy": "bel gor thu wen arf ost".split()}
    rows = [(i, " ".join("".join(rng.choice(stems[lang]) for _ in range(2)) for _ in range(30)), lang) for i in range(160) for lang in [rng.choice(["xx", "yy"])]]
    rows += [(900, None, "xx"), (901, "", None), (902, "12 34 !", "yy"), (None, "kato mira", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.languages(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (900, 901, 902))
    held = [(got[i].lang_pred, lang) for i, _, lang in rows[:160] if got[i].held_out]
    assert held and sum(a == b for a, b in held) >= 0.95 * len(held)
    for i, _, _ in rows[:160]:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language_id.languages(docs).collect()] == ["und"]


# quality rules


def slow_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_statistics():
    for text in (None, "", " \n", "a b c a b c", "é # x\né # x\n\x0b\n", "a b a b a b a", "x y\n" * 30, "one two three one two three one two three"):
        assert quality_mcd.statistics(None if text is None else text.encode())[:5] == slow_statistics(text)


def test_outliers_go_and_others_stay(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(60, 200))), "en", "s") for i in range(120)]
    rows += [(500 + i, " ".join(word() + "###" for _ in range(90)), "en", "s") for i in range(5)]
    rows += [(600, None, None, None), (601, "short", "en", None), (602, "a b c " * 40, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_mcd.quality(docs).collect()}
    assert all(got[i].kept for i in range(120)) and not any(got[500 + i].kept for i in range(5))
    assert all(got[i].base_failed and not got[i].kept for i in (600, 601, 602))


# benchmark decontamination


def test_windows(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(12))), (2, "Just Three words"), (3, None), (4, "..."), (None, "just three WORDS")], "item_id long, text string")
    rows = [(1, "x " + " ".join(f"W{k}" for k in range(12)) + " y"), (2, " ".join(f"w{k}" for k in range(9))), (3, "say just, three-words now just three words"), (4, None), (5, ""), (None, "É just"), (1, "again")]
    got = sorted(decontaminate.decontaminate(frame(spark, rows), items).collect(), key=lambda r: (str(r.doc_id), r.n_words))
    assert [(r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in got] == [
        (1, 1, 0, [], False), (1, 14, 12, ["1"], True), (2, 9, 0, [], False), (3, 8, 6, ["", "2"], True), (4, 0, 0, [], False), (5, 0, 0, [], False), (None, 2, 0, [], False)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(frame(spark, rows), none).filter("contaminated").count() == 0
    assert decontaminate.without_contaminated(frame(spark, rows), items).count() == 5


def test_windows_in_several_passes(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"alpha{i} beta gamma{i} delta") for i in range(20)], "item_id long, text string")
    docs = frame(spark, [(i, f"so alpha{i} beta gamma{i} delta it is") for i in range(20)])
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 1500)
    assert decontaminate.decontaminate(docs, items).filter("n_hit = 4 and n_items = 1").count() == 20


# lines


def test_fuzzy_lines(spark):
    fox = "The quick brown fox jumps over the lazy dog every single day of the week"
    rows = [(2, fox + "end\nnew line\n\n"), (1, "short\nshort\n \n" + fox), (3, None), (4, ""), (5, "same row\nhere"), (5, "same row\nhere"), (None, "new line")]
    got = fuzzy_lines.fuzzy_lines(spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, line string")).collect()
    texts = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=repr)
    want = [(1, "short\n \n" + fox, 3, 1), (2, "\n", 2, 2), (3, None, 0, 0), (4, "", 0, 0), (5, "same row\nhere", 2, 0), (5, "", 2, 2), (None, "new line", 1, 0)]
    assert texts == sorted(want, key=repr)


def test_components_of_a_chain_and_a_star(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components.connected_components(links.limit(0)).count() == 0


# licences


def test_licences(spark):
    rows = [(1, "Some text.\nReleased under the MIT License.\n"), (2, None), (3, ""), (None, "She got her driving license last week."), (4, "All rights reserved.\nLicensed under CC BY-NC 4.0.")]
    got = {r.doc_id: (r.n_paragraphs, list(r.families)) for r in license_scan.license_scan(frame(spark, rows)).collect()}
    assert got == {1: (2, ["mit"]), 2: (0, []), 3: (0, []), None: (1, []), 4: (2, ["cc-by-nc", "proprietary"])}


def test_licence_model_on_left_out_templates():
    fitted = license_scan.model()
    data = license_scan.variants(seed=99)
    right = sum(fitted.labels[fitted.probabilities(w).argmax()] == label for w, label in data)
    assert right >= 0.95 * len(data)


# personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and pii_crf.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii_crf.ORDER[s[2]], s[1]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice("a1.@ -+()_2") for _ in range(60))
        assert pii_crf.base_spans(text) == brute_spans(text)


def test_field_adds_spans_and_leaves_numbers_alone(spark):
    rows = [(1, "call (555) 123-4567 now"), (2, "on 12.03.2020 we paid 4,500 for v1.2.3"), (3, None), (4, "mail a.b@c.org or 10.0.0.1"), (5, "")]
    got = {r.doc_id: r for r in pii_crf.personal_data(frame(spark, rows)).collect()}
    assert got[1].spans == "phone:5:19" and got[2].spans == "" and got[3].spans == "" and got[5].spans == ""
    assert (got[4].n_email, got[4].n_ip, got[4].spans) == (1, 1, "email:5:14,ip:18:26")


def test_field_on_new_sentences():
    fitted, good, total = pii_crf.field(), 0, 0
    for text, spans, gold in pii_crf.examples(150, seed=77):
        want = {(spans[i][0], spans[j - 1][1]) for (i, j), k in gold.items() if k}
        found = pii_crf.base_spans(text)
        found += fitted.spans(text, found)
        total += len(want)
        good += sum(any(a < e and s < b for a, b, _ in found) for s, e in want)
    assert good >= 0.85 * total
