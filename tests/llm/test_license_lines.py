"""Licence notices that are wrapped over several lines, as file headers have them."""

import textwrap
import time

import pytest
from pyspark.sql import functions as F

from sessionloom.llm import license_scan

HEADERS = {
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
}
PROSE = [f"the {i} cats of the house sat on mats and it was {i * 7} times good" for i in range(300)]


@pytest.fixture(scope="module")
def model():
    return license_scan.train(PROSE)


@pytest.mark.parametrize("columns", [30, 50, 70, 80])
@pytest.mark.parametrize("family", HEADERS)
def test_wrapped(model, family, columns):
    lines = [" * " + line for line in textwrap.wrap(HEADERS[family], columns)]
    text = [PROSE[0], "", "/*", " * Copyright 2020 some people", *lines, " */", "", PROSE[1]]
    count, found = model.scan(text)
    assert count == len(text) - 2
    assert [of for _, of, *_ in found if of != "unknown"] == [family]


def test_two_notices_and_blank_lines(model):
    mit, bsd = (textwrap.wrap(HEADERS[family], 70) for family in ("mit", "bsd"))
    assert [of for _, of, *_ in model.scan([*mit, *bsd])[1] if of != "unknown"] == ["mit", "bsd"]
    # A blank line ends a paragraph.
    apart = [part for line in textwrap.wrap(HEADERS["bsd"], 40) for part in (line, " ")]
    assert not [of for _, of, *_ in model.scan(apart)[1] if of != "unknown"]


def test_column(spark, model):
    text = "first\n" + "\n".join(textwrap.wrap(HEADERS["gpl"], 72)) + "\n\nlast"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = license_scan.license_scan(frame, model=model).collect()[0]
    assert row.n_paragraphs == text.count("\n") and "gpl" in [x.family for x in row.licences]


def test_marks_and_long_texts(model):
    """Lines of marks count for nothing, and a text of 100,000 lines takes seconds."""
    notice = textwrap.wrap(HEADERS["gpl"], 60)
    marked = [x for line in notice for x in (line, "-----", "***")]
    families = lambda lines: [x[1] for x in model.scan(lines)[1] if x[1] != license_scan.UNKNOWN]
    assert families(notice) == ["gpl"] == families(marked)
    began = time.monotonic()
    for filler in ("---", "of the one", "Licensed under the"):
        count, found = model.scan([*notice, *[filler] * 100_000, *notice])
        assert count == 100_000 + 2 * len(notice)
        assert [x[1] for x in found if x[1] == "gpl"] == ["gpl", "gpl"]
    assert time.monotonic() - began < 60


def test_rows_and_clashing_names(spark, model):
    rows = [(1, "Released under the MIT License.", "x"), (1, "Released under the MIT License.", "x"), (2, None, None), (None, "", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, licences string").withColumn("n_paragraphs", F.lit(7))
    found = license_scan.license_scan(frame, model=model)
    assert found.columns == ["doc_id", "n_paragraphs", "licences"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_paragraphs, [x.family for x in r.licences]) for r in found.collect()) == [
        (False, 1, 1, ["mit"]), (False, 1, 1, ["mit"]), (False, 2, 0, []), (True, 0, 0, []),
    ]
