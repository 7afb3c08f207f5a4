"""Leaks that decontamination must find although words of them were changed, or they are short."""

import numpy as np

from foldlake.llm import decontaminate as dc


def words(seed, n):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("bdfgklmnprst")) + rng.choice(list("aeiou")) for _ in range(3)) for _ in range(n)]


def edited(item, *places):
    return " ".join("changed" if i in places else w for i, w in enumerate(item))


def found(spark, documents, docs, items):
    bench = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    rows = [(i, f"Some text stands before. {t} and more text follows") for i, t in enumerate(docs, 1)]
    return {(r.doc_id, r.item_id) for r in dc.matches(documents(rows), bench).collect()}


def test_one_changed_word_anywhere(spark, documents):
    items = [words(n, n) for n in (8, 11, 15, 18, 20, 26)]
    docs = [(k, edited(item, at)) for k, item in enumerate(items, 1) for at in range(len(item))]
    got = found(spark, documents, [t for _, t in docs], [" ".join(item) for item in items])
    assert got == {(i, k) for i, (k, _) in enumerate(docs, 1)}


def test_scattered_changes_and_long_quotes(spark, documents):
    item = words(57, 57)
    docs = [edited(item, 14, 28, 42), " ".join(item[:36]), " ".join(item[:20])]
    assert found(spark, documents, docs, [" ".join(item)]) == {(1, 1), (2, 1)}


def test_one_inconsistent_slot_drops_its_windows_only(spark, documents):
    item = words(3, 50)
    item[2], item[46] = "17", "17"
    docs = [" ".join([*item[:46], "18", *item[47:]])]
    assert found(spark, documents, docs, [" ".join(item)]) == {(1, 1)}


def test_short_items_and_items_without_words_of_their_own(spark, documents):
    numbers = " ".join(str(i * i) for i in range(11, 23))
    docs = ["they ask Where is it kept now", numbers, " ".join(str(i * i + i % 2) for i in range(11, 23)), "where is it put now"]
    assert found(spark, documents, docs, ["Where is it kept", numbers]) == {(1, 1), (2, 2)}


QUESTIONS = [
    "{A} has {x} cows and {y} horses on a farm near {P}. If {A} buys {z} more cows, how many animals are there on the farm now?",
    "A train leaves {P} at {t} and travels {x} {u} before it stops. After the stop it goes on for {y} {u}. How long is the whole way?",
    "{A} reads {x} pages of a book every day. The book has {z} pages in all. How many days does it take {A} to finish the book?",
    "In the school of {P} there are {x} classes with {y} pupils each. On Monday {z} pupils are ill. How many pupils come to school?",
    "The garden of {A} is {x} {u} long and {y} {u} wide. What is the area of the garden, and how long is the fence around it?",
    "{A} and {B} share {z} apples so that {A} gets {x} more than {B}. How many apples does each of the two get in the end?",
    "How much does it cost to send {x} parcels from {P} if every parcel weighs {y} {v} and the post takes {t} for each of them?",
]
ENGLISH = "a and on if how many are there the at it in of with each is does to take all every so that gets more than from long before after".split()


def asked(rng, question):
    pick = lambda *values: values[rng.integers(len(values))]
    number = lambda: pick("two", "nine", "twelve", str(rng.integers(2, 90)), str(rng.integers(100, 900)))
    a, b = rng.permutation(["Tom", "Anna", "Mehmet", "Yuki", "Olga"])[:2]
    return question.format(A=a, B=b, P=pick("Lisbon", "Oslo", "Quito"), x=number(), y=number(), z=number(), t=pick("5", "11", "seven"), u=pick("m", "ft", "km"), v=pick("g", "kg", "lb"))


def test_questions_with_other_numbers_names_and_units(spark, documents):
    rng = np.random.default_rng(12)
    items = [asked(rng, q) for q in QUESTIONS] + [" ".join(ENGLISH)]
    docs = [(k, asked(rng, q)) for k, q in enumerate(QUESTIONS, 1) for _ in range(15)]
    clean = [" ".join(rng.choice(ENGLISH + words(9, 40), 60)) for _ in range(100)]
    got = found(spark, documents, [t for _, t in docs] + clean, items)
    right = {(i, k) for i, (k, _) in enumerate(docs, 1)}
    assert len(got & right) >= 0.9 * len(right), len(got & right) / len(right)
    assert got <= right


def kinds(text):
    codes, own = dc.tokens(text, dc.Canonical())
    return [f"{' NAUV'[int(c)]}:{w}" if c <= dc.VARIABLE else w for c, w in zip(codes, own, strict=True)]


def test_slots_of_several_words():
    assert kinds("From New York it is twenty five kilometres, or 3 million square feet") == [
        "From", "A:New York", "it", "is", "N:twenty five", "U:kilometres", "or", "N:3 million", "U:square feet"
    ]
    assert kinds("at 60 miles per hour for 5km, 20% or 20 % of 7 sq m") == [
        "at", "N:60", "U:miles per hour", "for", "N:5", "U:km", "N:20", "U:%", "or", "N:20", "U:%", "of", "N:7", "U:sq m"
    ]
    assert kinds("to Tom, Ann and 4 one 1 2") == ["to", "A:Tom", "A:Ann", "and", "N:4", "N:one", "N:1", "N:2"]
    assert kinds("the One Two Three Four Five Red Green Blue White Black") == ["the", "N:One Two Three Four Five", "A:Red Green Blue White", "A:Black"]
    assert kinds("let x, y be a dog and a + b is a. (A) per sq") == [
        "let", "V:x", "V:y", "be", "a", "dog", "and", "V:a", "+", "V:b", "is", "V:a", "V:A", "per", "sq"
    ]
    assert kinds("") == [] == kinds(" .,; \n")


#: A question and other forms of it: each has other values, and units, names or variables of another number of words.
FORMS = [
    ("The garden of Anna is 20 m long and 30 m wide. What is the area of the garden, and how long is the fence around it?",
     "The garden of Maria Lopez is 45 square metres long and 60 square metres wide. What is the area of the garden, and how long is the fence around it?"),
    ("Let x and y be whole numbers so that x is twice as large as y and the sum of x and y is 36. What is the value of x?",
     "Let a and b be whole numbers so that a is twice as large as b and the sum of a and b is 81. What is the value of a?"),
    ("A tank holds 200 litres of water and loses 3 litres per hour. After how many hours is the tank of Peter half empty?",
     "A tank holds two thousand gallons of water and loses 11 cubic feet a day. After how many days is the tank of Mary Ann half empty?"),
    ("A train leaves Boston at 60 km per hour and a second train leaves Denver two hours later. When do the trains meet on the way?",
     "A train leaves New Orleans at 95 mph and a fourth train leaves San Diego seventy five minutes later. When do the trains meet on the way?"),
    ("The tower is 300 meters high and its shadow has 45 centimeters at noon. By how much does it grow until the evening comes?",
     "The tower is 90ft high and its shadow has 7 kilometres at noon. By how much does it grow until the evening comes?"),
]


def test_forms_with_slots_of_another_length(spark, documents):
    items, docs = [a for a, _ in FORMS], [b for _, b in FORMS]
    swapped = [
        docs[1].replace("value of a", "value of b").replace("a is twice", "b is twice").replace("sum of a and b", "sum of b and b"),
        "The garden is long and wide. What a fence. How large is the area, and how long does a tank hold water on the way to the train?",
    ]
    assert found(spark, documents, docs + swapped, items) == {(i, i) for i in range(1, len(FORMS) + 1)}


def test_a_name_that_takes_in_the_word_before_it_is_the_same_name(spark, documents):
    item = "Anna has 7 red hens and buys 9 more hens. How many eggs does Anna sell if each of the hens of Anna lays 4 eggs"
    docs = [f"Yesterday {item}", f"Yesterday {item.replace('Anna', 'Tom')}", f"Yesterday {item.replace('Anna', 'Tom', 2)}"]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.reworded for r in dc.matches(documents(list(enumerate(docs, 1))), bench).collect()}
    assert got == {1: False, 2: True}


def test_texts_cut_together_are_as_cut_alone():
    texts = ["", "a b\n5km", ".", "New\nYork 5% is ( ) Tom", "  ", "z" * dc.GROUP, *[a for a, _ in FORMS], *[b for _, b in FORMS]]
    assert list(dc.groups([])) == [] and [i for g in dc.groups(texts) for i in range(len(texts))[g]] == list(range(len(texts)))
    codes, own, ends = dc.tokens_of(texts, dc.Canonical())
    alone = [dc.tokens(text, dc.Canonical()) for text in texts]
    assert list(own) == [w for _, words in alone for w in words]
    assert codes.tolist() == [c for some, _ in alone for c in some.tolist()]
    assert ends.tolist() == np.cumsum([len(some) for some, _ in alone]).tolist()
