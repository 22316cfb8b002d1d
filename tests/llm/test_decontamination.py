import random

import numpy as np
import pytest

from changelake.llm.decontamination import NAME, NUMBER, UNIT, decontaminate, template


def tokens(text):
    data = np.frombuffer(text.encode(), np.uint8)
    found = template(data, np.array([0, len(data)]))
    kinds = {NUMBER: "<number>", NAME: "<name>", UNIT: "<unit>"}
    return [kinds.get(value, "w") for value in found.hash]


def test_placeholders_are_typed():
    assert tokens("Anna has 3 kg of apples. Then Élodie ate 1.5, said Bob!") == (
        "w w <number> <unit> w w w <name> w <number> w <name>".split()
    )
    assert tokens("kg of it\nNew line, THE END, été, 12km/h %%% -- ok") == "w w w w w w w w <number> w".split()
    assert tokens("") == tokens(" ** \n") == []


QUESTION = "If Anna buys 12 pens and Bob buys 7 pens, how many pens do Anna and Bob have after Anna loses 12 of them"


def run(spark, documents, items):
    df = spark.createDataFrame([(*row, 1) for row in documents], "doc_id long, text string, items int").repartition(2)
    benchmark = spark.createDataFrame([(*row, 1) for row in items], "item_id long, text string, doc_id int")
    return {(row.doc_id, row.text_hash): row for row in decontaminate(df, benchmark).collect()}


def by_id(found):
    return {key[0]: row for key, row in found.items()}


def test_changed_values_match_if_they_are_consistent(spark):
    changed = QUESTION.replace("Anna", "Clara").replace("Bob", "Dan").replace("12", "30").replace("7", "9")
    broken = changed.replace("after Clara loses 30", "after Erik loses 44")
    noise = " ".join(f"x{chr(97 + n)}y" for n in range(20))
    documents = [
        (1, f"{noise}. {QUESTION}. {noise}"), (2, f"{noise}. {changed}. {noise}"), (3, noise), (4, broken),
        (5, QUESTION.replace(" ", "\n** ").lower().replace("anna", "Anna").replace("bob", "Bob")),
    ]
    found = by_id(run(spark, documents, [(70, QUESTION), (71, "four other words here")]))
    assert [(found[n].contaminated, found[n].items, found[n].exact) for n in (1, 2, 3)] == [
        (True, [70], True), (True, [70], False), (False, [], False),
    ]
    assert found[1].covered >= 20
    # A name that stands for two people in one copy is no exchange of values.
    assert not found[4].contaminated


def test_plain_passages_equal_brute_force(spark):
    draw = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]
    items = [(n, " ".join(draw.choice(vocabulary) for _ in range(draw.choice([3, 5, 9, 13, 30])))) for n in range(30)]
    documents = []
    for number in range(150):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(40))]
        if number % 2:
            item = draw.choice(items)[1].split()
            begin = draw.randrange(len(item))
            words += item[begin if number % 3 else 0 :]
            words += [draw.choice(vocabulary) for _ in range(draw.randrange(10))]
        documents.append((number, " ".join(words)))

    def leaked(words, item):
        size = min(8, len(item))
        if size < 4:
            return False
        enough = min(13, -(-len(item) * 8 // 10))
        for offset in range(-len(item), len(words)):
            same = [0 <= offset + k < len(words) and words[offset + k] == item[k] for k in range(len(item))]
            covered = set()
            for k in range(len(item) - size + 1):
                if all(same[k : k + size]):
                    covered.update(range(k, k + size))
            if covered and len(covered) >= enough:
                return True
        return False

    expected = {n: [i for i, item in items if leaked(text.split(), item.split())] for n, text in documents}
    found = by_id(run(spark, documents, items))
    assert {n: row.items for n, row in found.items()} == expected
    assert {n for n, row in found.items() if row.contaminated} == {n for n, each in expected.items() if each}


@pytest.mark.parametrize("items", [[], [(1, None), (None, QUESTION), (2, ""), (3, "too few words")]])
def test_items_that_match_nothing(spark, items):
    found = run(spark, [(1, QUESTION), (2, None), (3, "too few words")], items)
    assert not any(row.contaminated for row in found.values()) and len(found) == 3


def test_nulls_repeats_and_long_texts(spark):
    long = "ab " * 200_000 + QUESTION + " cd" * 200_000
    documents = [(None, QUESTION), (None, None), (4, QUESTION), (4, "nothing"), (5, ""), (6, long), (7, QUESTION + ". " + QUESTION)]
    found = run(spark, documents, [(1, QUESTION), (2, QUESTION)])
    assert sorted(((row.doc_id, row.contaminated) for row in found.values()), key=str) == sorted(
        [(None, True), (None, False), (4, True), (4, False), (5, False), (6, True), (7, True)], key=str
    )
    assert all(row.items == [1, 2] for row in found.values() if row.contaminated)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate(df, spark.createDataFrame([(1, QUESTION)], "item_id long, text string")).collect() == []


def test_items_poor_in_words_match_with_their_values(spark):
    items = [(1, "Compute 48 + 27 - 13 * 5"), (2, "Did Anna Maria, Bob Dylan, Carl Orff, Dora Maar or Emil Nolde paint 3 of 14 works"), (3, "12, 13, 14, 15, 16")]
    documents = [(n, f"a b c. {text}, he said. d e f") for n, text in items] + [(4, "Compute 49 + 27 - 13 * 5 and 12, 13, 14, 15, 17")]
    found = by_id(run(spark, documents, items))
    assert {n: row.items for n, row in found.items()} == {1: [1], 2: [2], 3: [3], 4: []}
    assert all(found[n].exact for n in (1, 2, 3))


def test_scripts_without_spaces(spark):
    items = [(1, "下列哪一种动物不是哺乳动物?"), (2, "日本で一番高い山はなんですか。"), (3, "ประเทศไทยมีกี่จังหวัด"), (4, "𠀀𠀁𠀂𠀃𠀄")]
    documents = [(n, f"这是文字。{text}答案在后面") for n, text in items] + [(5, "这是一段没有题目的文字。下列哪一种植物"), (6, "「日本で、一番高い山は なんですか」")]
    found = by_id(run(spark, documents, items))
    assert {n: row.items for n, row in found.items()} == {1: [1], 2: [2], 3: [3], 4: [4], 5: [], 6: [2]}


def test_runs_of_names_and_numbers_are_one_placeholder():
    assert tokens("We saw New York, Paris and 1 000 000 of twenty five or sixty-one miles") == (
        "w w <name> <name> w <number> w <number> w <number> <unit>".split()
    )


LONGER = "the train that leaves Boston at noon runs along the coast for three hours before it reaches the harbour town"


def test_copies_with_shifted_parts_match(spark):
    documents = [
        (1, LONGER.replace("Boston", "New York")), (2, LONGER.replace("coast", "rocky coast")), (3, LONGER.replace("three", "twenty five")),
        (4, LONGER.replace("along the", "slowly along the")), (5, LONGER.replace("at noon runs along the coast for", "x y z")),
    ]
    found = by_id(run(spark, documents, [(1, LONGER)]))
    assert {n: row.contaminated for n, row in found.items()} == {1: True, 2: True, 3: True, 4: True, 5: False}


def test_slots_are_checked_across_shifted_parts(spark):
    item = "the train from Boston runs along the wide coast for hours and then it comes back to Boston by the night"
    shifted = item.replace("hours", "many hours")
    documents = [(1, shifted.replace("Boston", "Paris")), (2, shifted.replace("Boston", "Paris", 1).replace("Boston", "Rome"))]
    found = by_id(run(spark, documents, [(1, item)]))
    assert found[1].contaminated and not found[2].contaminated


def test_short_items_match_after_a_colon_or_comma(spark):
    items = [(1, "What is the capital of France"), (2, "Which Anna wrote this old book")]
    documents = [(1, "Q: What is the capital of France"), (2, "he asked, Which Anna wrote this old book"), (3, "we know, Paris is the capital of France")]
    found = by_id(run(spark, documents, items))
    assert {n: row.items for n, row in found.items()} == {1: [1], 2: [2], 3: []}
