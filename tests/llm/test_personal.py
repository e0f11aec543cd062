from tracewright.llm import personal as P

FILLER = [
    ("Mail anna@example.com today.", "email"), ("Reply address: b.lee [at] example.org.", "email"), ("Call +44 20 7946 0126 if late.", "phone"), ("The desk line is (408) 555 0123.", "phone"),
    ("Passport or ID no. QQ865857B was on it.", "id_number"), ("National ID 907-38-5892 goes on it.", "id_number"), ("Visitors go to 234 Harbour Street, second floor.", "street_address"),
    ("Pick up at Lindenweg 88 on Friday.", "street_address"), ("My name is Marta Isterham and I own it.", "person_name"), ("Ask Osklund, Bruno about the list.", "person_name"),
    ("Job 415555018591999 finished as chunk 12-345-1369.", None), ("Build 16.4.12.7 uses node@18.2 and tag @here.", None), ("Range 2026-06-19 to 2026-07-02, batch 0x9f3a.", None),
    ("Row ids 100045510 to 10004670715 are pending.", None), ("Will Grant access once it is there.", None), ("See the Avenue view and the Street layer.", None), ("The deploy@runner-7 account is new.", None),
]


def run(spark, texts, f=P.find):
    df = spark.createDataFrame([("f", i, t, "x", "y") for i, t in enumerate(texts)], "field_name string, row_id bigint, text string, kind string, votes string")
    return f(df)


def spans(spark, texts):
    out = {}
    for r in run(spark, texts + [t for t, _ in FILLER] * 5).collect():
        if r["row_id"] < len(texts):
            out.setdefault(r["row_id"], []).append((r["kind"], r["span_text"]))
    return [sorted(out.get(i, [])) for i in range(len(texts))]


def test_each_kind_and_its_decoys(spark):
    assert [[k for k, _ in s] for s in spans(spark, [t for t, _ in FILLER])] == [[k] if k else [] for _, k in FILLER]


def test_spans_are_exact(spark):
    texts = [
        "The tel is 1-514-555-0189 ext. 192. Dr. Priya Junbek called.", "寄送地点是296-C Velsitor Rd.，请核对。负责人是艾丽莎·奎里斯顿，请先问一下。", "请把文件发到jonas+x [at] mail.example.net。联系电话0049 30 23125 794，午后可打。",
        '{"ship_to": "90 rue de Calshubrook", "assignee": "M. Osklund", "callback": "759.555.0174", "holder_id": "QQ 82 96 82 C"}', "Regards, Samir Zemford The tool is there. cc Elsa.Lom@desk.test on it.", "Mit freundlichen Grüßen, Narmere, Yusuf",
        "Die Kennnummer 000000199611206368 steht im Vertrag. Treffpunkt ist Rudlowsteadstraße 4b, Hinterhaus.",
    ]
    assert spans(spark, texts) == [
        [("person_name", "Priya Junbek"), ("phone", "1-514-555-0189")], [("person_name", "艾丽莎·奎里斯顿"), ("street_address", "296-C Velsitor Rd.")],
        [("email", "jonas+x [at] mail.example.net"), ("phone", "0049 30 23125 794")],
        [("id_number", "QQ 82 96 82 C"), ("person_name", "M. Osklund"), ("phone", "759.555.0174"), ("street_address", "90 rue de Calshubrook")],
        [("email", "Elsa.Lom@desk.test"), ("person_name", "Samir Zemford")], [("person_name", "Narmere, Yusuf")], [("id_number", "000000199611206368"), ("street_address", "Rudlowsteadstraße 4b")],
    ]


def test_redaction_keeps_the_rest(spark):
    texts = [t for t, _ in FILLER] * 5
    got = {r["row_id"]: r["text"] for r in run(spark, texts, P.redact).collect()}
    assert got[0] == "Mail [EMAIL] today." and got[2] == "Call [PHONE] if late." and got[9] == "Ask [PERSON_NAME] about the list."
    assert all(got[i] == t for i, (t, k) in enumerate(FILLER) if k is None)


def test_edges(spark):
    long = "x " * 300_000 + "write to zoe@example.com"
    assert spans(spark, [None, "", long, "no data here", "cc a@example.com and a@example.com"]) == [[], [], [("email", "zoe@example.com")], [], [("email", "a@example.com")] * 2]
    assert run(spark, []).count() == 0 and run(spark, [None]).count() == 0 and run(spark, [], P.redact).count() == 0


def bits(*names):
    return sum(1 << P.VOTES.index(n) for n in names)


ROWS = [
    ("phone", bits("form", "before"), 200), ("phone", bits("form"), 60), ("phone", bits("not_form", "technical"), 300), ("phone", bits("not_form"), 10),
    ("person_name", bits("form", "gazetteer", "field"), 30), ("person_name", bits("form", "gazetteer"), 40), ("person_name", bits("gazetteer"), 90),
    ("person_name", bits("not_form", "common"), 4000), ("person_name", bits("not_form"), 80), ("email", bits("form"), 500), ("email", bits("not_form"), 3),
]


def test_label_model_weighs_labelers():
    p = P.fit_label_model(ROWS)
    assert p["phone", bits("form", "before")] > 0.9 and p["phone", bits("form")] > 0.5
    assert p["phone", bits("not_form", "technical")] < 0.05 and p["phone", bits("not_form")] < 0.5
    assert p["email", bits("form")] > 0.5 > p["email", bits("not_form")]
    assert p["person_name", bits("form", "gazetteer", "field")] >= p["person_name", bits("form", "gazetteer")] >= p["person_name", bits("gazetteer")] > 0.5


def test_decisions_do_not_depend_on_the_size_of_the_corpus():
    sample = [(k, v, f"f{i}", i, i + 1) for k, v, _ in ROWS for i in range(4)]
    decided = []
    for times in (1, 10, 1000):
        counts = {(k, v): n * times for k, v, n in ROWS}
        c = P.fit_classifier(P.fit_label_model([(k, v, n) for (k, v), n in counts.items()]), counts, sample)
        decided.append([round(c.probability(*s), 6) for s in sample])
    assert decided[0] == decided[1] == decided[2]


def test_one_more_vote_for_never_lowers_a_probability():
    counts = {(k, v): n for k, v, n in ROWS}
    c = P.fit_classifier(P.fit_label_model(ROWS), counts, [(k, v, "x", 1, 2) for k, v, _ in ROWS])
    for kind in ("phone", "person_name", "email"):
        for votes in range(1 << len(P.VOTES)):
            p = c.probability(kind, votes, "x", 1, 2)
            assert all(c.probability(kind, votes | bits(v), "x", 1, 2) >= p - 1e-9 for v in P.FOR)
            assert all(c.probability(kind, votes | bits(v), "x", 1, 2) <= p + 1e-9 for v in P.AGAINST)


def test_names_that_no_list_has_are_proposed_and_found_by_their_cues(spark):
    got = spans(spark, ["My name is Xolani Quersted and I own it.", "Regards, Wrenna Oskdale", "The Quersted Oskdale module"])
    assert got == [[("person_name", "Xolani Quersted")], [("person_name", "Wrenna Oskdale")], []]
    assert {c[2] for c in P.candidates("about Quersted Oskdale and 123456789012")} >= {"person_name", "phone"}
