import pytest

from tracewright.llm import languages as L
from tracewright.llm import pairs as P

ASK = "Set up a weekly report that lets the router collect 14 snapshot rows each Monday. Report uptime and lag in one table."


@pytest.mark.parametrize("text", [None, "", "  \n", "...", "<thinking>\n\n</thinking>", "<tool_call>\n</tool_call>"])
def test_empty(text):
    assert P.defect(ASK, text) == "empty"


@pytest.mark.parametrize(
    "text",
    [
        "The plan has three parts: read the table, compare it and", "I saved it as notes/fold_rep", "I saved it. See notes/fold_rep.", "Done.\n```\nsort --in a/b.csv", 'Ok.\n<tool_call>\n{"tool": "exec", "params": {"path": "a/b.csv", "lim',
        "<thinking>\nFirst I read it.", "- notes/a.csv\n- notes/b.par", "请压缩季度的目录，月底归类档", "It is done, and the rest follo…",
    ],
)
def test_truncated(text):
    assert P.defect(ASK, text) == "truncated" or L.language(text) == "zh" and P.truncated(text)


@pytest.mark.parametrize(
    "text",
    [
        "The table now holds 8 rows.", "I saved it.\n- notes/a.csv\n- data/b.yaml", 'Ok.\n<tool_call>\n{"tool": "exec", "params": {"a": [1, 2]}}\n</tool_call>', "Done.\n```\nsort --in a/b.csv\n```", "He said: \"it's done.\"",
        "<thinking>\nfine\n</thinking>\nAll rows are there.", "I saved it as notes/fold.csv.", "Is there more to do?",
    ],
)
def test_sound(text):
    assert P.defect(ASK, text) is None


@pytest.mark.parametrize(
    "text",
    [
        "I'm sorry, but I can't restore the alert.", "I won't export it; this is outside what I may do. Is there something else I can do?", "That is a request I have to decline.", "My guidelines do not allow work on the list.",
        "No, I would rather not take part in this task.", "I must refrain from touching notes/a.csv.", "Unfortunately helping with that isn't possible for me.", "Tut mir leid, dabei kann ich nicht helfen.", "Ich darf den Bestand leider nicht sortieren.",
        "Lo siento, no puedo ayudar con eso.", "Debo rechazar esta petición.", "这个请求我不能协助。", "很遗憾，清理jobs/a.py超出了我的权限，恕不处理。",
    ],
)
def test_refusal(text):
    assert P.defect(ASK, text) == "refusal"


@pytest.mark.parametrize(
    "text",
    ["Sorry for the wait; the list is stored in data/a.csv.", "I can't open a/b.csv while the cache holds it, so I merged a copy and the list is there.", "The tool was not able to read a/b.csv at first, then exec did it."],
)
def test_no_refusal(text):
    assert P.defect(ASK, text) is None


@pytest.mark.parametrize("text", [ASK, ASK.upper(), f"> {ASK}", f'"{ASK}"', "Task: " + ASK.lower(), ASK.replace("weekly ", "").replace("each", "eahc")])
def test_copy(text):
    assert P.defect(ASK, text) == "copy_of_prompt"


def test_quoting_is_no_copy():
    assert P.defect(ASK, "You asked for uptime and lag in one table. " + "The router now sends its snapshot rows to the archive, and the table is built from them every Monday at noon.") is None


def test_languages():
    de, zh, en, es = "Der Bericht wurde am Montag geprüft und abgelegt.", "请核对双语的合同，月底导出账单。", "The report is in the archive now.", "El informe quedó en el archivo y no hace falta más."
    assert [L.language(x) for x in (de, zh, en, es, "notes/a.csv 17")] == ["de", "zh", "en", "es", None]
    assert P.defect(ASK, de) == P.defect(ASK, zh) == P.defect(ASK, es) == "other_language" and P.defect(ASK, en) is None
    assert P.defect(ASK + " Please answer in German.", de) is None and P.defect(ASK + " Please answer in German.", en) == "other_language"
    assert P.defect(ASK + " Reply in Spanish, please.", es) is None and P.defect(ASK + " Write the answer in Chinese.", zh) is None


def test_tiles_cover_each_word_once():
    a, b = "a b c d e f a b c".split(), "d e f a b c".split()
    assert P.tiles(a, b) == 6 and P.tiles([], b) == 0 and P.tiles(a, ["x"]) == 0


def test_table(spark):
    schema = "pair_no bigint, prompt array<struct<role string, content string>>, chosen string, rejected string, request string, defect string"
    rows = [(1, [("user", ASK)], None, "The table is there."), (1, [("user", ASK)], None, "The table is there."), (2, None, "Fine and", ASK), (3, [], "ok.", ""), (4, [("user", None)], "word " * 200_000 + ".", None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    got = sorted(tuple(r) for r in P.defective_sides(df).collect())
    assert got == [(1, "chosen", "empty"), (1, "chosen", "empty"), (2, "chosen", "truncated"), (3, "rejected", "empty"), (4, "rejected", "empty")]
    assert P.defective_sides(df.filter("false")).count() == 0


def test_tiling_of_repetitive_texts():
    import random
    import time

    def plain(a, b, least):
        runs = []
        for i in range(len(a)):
            for j in range(len(b)):
                if not (i and j and a[i - 1] == b[j - 1]):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                        k += 1
                    if k >= least:
                        runs.append((k, i, j))
        ua, ub, n = set(), set(), 0
        for k, i, j in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
            start = 0
            while start < k:
                if i + start in ua or j + start in ub:
                    start += 1
                    continue
                stop = start
                while stop < k and i + stop not in ua and j + stop not in ub:
                    stop += 1
                if stop - start >= least:
                    ua |= set(range(i + start, i + stop))
                    ub |= set(range(j + start, j + stop))
                    n += stop - start
                start = stop
        return n

    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("ab") for _ in range(rng.randrange(0, 60))] for _ in range(2))
        assert P.tiles(a, b, 2) == plain(a, b, 2) and P.tiles(a, b) == plain(a, b, 3)
    at = time.time()
    assert P.tiles(["the"] * 20_000, ["the"] * 20_000) == 20_000 and time.time() - at < 5
