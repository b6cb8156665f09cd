from corpusqa.llm import line_dedup as d

LICENSE = "Licensed under the Common License version 2.0 of the year"


def run(spark, docs, **kw):
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_lines string, dropped string")
    out = d.dedup_lines(frame, **kw)
    return out, {(r.doc_id, r.text): r for r in out.collect()}


def test_templates_and_cases(spark):
    docs = [
        (1, f"own words of one\n{LICENSE} 2001\n\nend 1"),
        (2, f"{LICENSE}  2002\nown words of two"),
        (3, f"own words of three\n{LICENSE} 2003\n{LICENSE} 2004"),
        # a field without numerals, after the leading tokens
        (4, "Session opened for user alice on this host by the system now"),
        (5, "Session opened for user bob on this host by the system now"),
        (6, "Session opened for user carol on this host by the system now"),
        # fewer tokens: another leaf
        (7, "Session opened for user bob on this host by the system"),
        # numerals alone are no template
        (8, "1 2 3"), (9, "1 2 3"), (10, "1 2 3"),
        (11, None), (12, ""), (13, "\n \n"),
        # repeated rows are one document
        (14, "twice the same row"), (14, "twice the same row"), (15, "twice the same row"),
        (None, "no id at all"),
    ]
    out, rows = run(spark, [(*r, "x", None) for r in docs])
    assert out.columns == ["doc_id", "text", "n_lines", "dropped", "_n_lines", "n_dropped"]
    text = {k[0]: r.text for k, r in rows.items()}
    assert text[1] == docs[0][1]
    assert text[2] == "own words of two"
    assert text[3] == "own words of three"
    assert (text[4], text[5], text[6]) == (docs[3][1], "", "")
    for i in (7, 8, 9, 10, 11, 12, 13, 14, 15, None):
        assert text[i] == dict(docs)[i], i
    counts = {k[0]: (r["_n_lines"], r.n_dropped) for k, r in rows.items()}
    assert counts[3] == (3, 2) and counts[11] == (0, 0) and counts[12] == (1, 0) and counts[13] == (3, 0)
    assert out.count() == len(docs)


def test_only_changed_tokens_are_fields(spark):
    base = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]

    def line(changed):
        own = list(base)
        for place, word in changed.items():
            own[place] = word
        return " ".join(own)

    # one word of its own every twelfth of the line, so that no run is equal
    docs = [(i, line({p: f"own{'xyzw'[i]}{chr(97 + p % 26)}" for p in range(10, 200, 15)})) for i in range(4)]
    # under 0.7 of the tokens are constant
    docs += [(10 + i, line({0: "other"} | {p: f"own{'xyz'[i]}{p % 7 * 'a'}" for p in range(10, 200, 3)})) for i in range(3)]
    # the documents that hold a token count, not the lines: two of them hold three lines
    docs += [(20, "\n".join(line({0: "third", p: "one"}) for p in (50, 60))), (21, line({0: "third", 70: "two"}))]
    docs += [(22, docs[0][1])]
    docs += [docs[1]]  # a row that repeats
    _, rows = run(spark, [(*r, "x", None) for r in docs])
    text = {k[0]: r.text for k, r in rows.items()}
    assert text[0] == docs[0][1]
    assert [text[i] for i in (1, 2, 3, 22)] == [""] * 4
    for i, own in docs[4:9]:
        assert text[i] == own, i


def test_long_lines_recur_from_two_documents_on(spark):
    spell = lambda i: "w" + "".join("abcdefghij"[int(c)] for c in str(i))
    line, short = " ".join(map(spell, range(d.LONG))), " ".join(map(spell, range(d.LONG - 1)))
    docs = [
        (1, f"own words of one\n{line}"),
        (2, f"own words of two\n  {line}\nend"),
        (3, short), (4, short),  # a token less
        (5, f"five {line}\nfive {line}"),  # in one document alone
        (6, f"six {short} 7"), (7, f"six {short} 8"),  # not equal
    ]
    _, rows = run(spark, [(*r, "x", None) for r in docs])
    text = {k[0]: r.text for k, r in rows.items()}
    assert text == dict(docs) | {2: "own words of two\nend"}


def test_long_text_and_empty_table(spark):
    many = "\n".join(f"line {'abc'[i % 3]} of many lines" for i in range(60_000))
    _, rows = run(spark, [(i, many + f"\nown line of document {'xyz'[i]}", "x", None) for i in range(3)], min_docs=3, similar=1.0)
    text = {k[0]: r.text for k, r in rows.items()}
    assert text[0].split("\n") == ["line a of many lines", "line b of many lines", "line c of many lines", "own line of document x"]
    assert (text[1], text[2]) == ("own line of document y", "own line of document z")
    _, rows = run(spark, [])
    assert not rows


def test_only_built_in_functions(spark):
    frame = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = d.dedup_lines(frame)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "MapIn"))
