import random

from corpusloom.llm import quality_mcd


def test_repeated_lines_and_phrases_go_from_a_clean_source(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8)))
    line = lambda: " ".join(word() for _ in range(10))
    rows = [(i, "\n".join(line() for _ in range(rng.randint(8, 20)))) for i in range(150)]
    for i in range(5):
        short = [f"{word()} {word()}" for _ in range(2)]  # repeated lines, too short for repeated phrases to fail the base
        rows.append((500 + i, "\n".join(x for _ in range(20) for x in (line(), rng.choice(short)))))
        phrase = " ".join(word() for _ in range(6))
        rows.append((600 + i, "\n".join(f"{line()} {phrase}" for _ in range(15))))
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_mcd.quality(docs).collect()}
    planted = [got[k + i] for k in (500, 600) for i in range(5)]
    assert not any(r.base_failed for r in planted) and not any(r.kept for r in planted)
    assert sum(got[i].kept for i in range(150)) >= 148
