"""License texts that are not word for word those of the templates."""

from beaconry.llm import licenses, queries

ISC = "Permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted"
BSD = "Redistribution and use in source and binary forms, with or without {}modification, are permitted provided that the following {}conditions are met"


def test_words_missing_or_put_in(spark):
    texts = {1: ISC.format(""), 2: "Copyright 1999. " + ISC.format(""), 3: ISC.format("/or"), 4: BSD.format("any ", "three "), 5: BSD.format("", ""),
             6: "distribute this software for any purpose with or without fee", 7: "fee " * 20 + "distribute this software for any purpose with or without fee " + "use " * 20}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs, queries.PHRASES).collect()}
    assert [got[d].labels for d in range(1, 8)] == ["isc", "isc", "isc", "bsd", "bsd", "", ""]
    assert got[1].score == got[2].score == 19 / 20 and got[3].score == got[5].score == got[4].score == 1.0
    assert [p.start for p in got[1].places] == [0] and [p.start for p in got[2].places] == [1]
