"""Operator 6, license scans: notices found in overlapping windows of a document.

Templates are notices and the opening parts of license texts. Those of one size
class are sought in windows of four times the class's least size that overlap by
half, so a notice lies whole in some window. MinHash bands over what a window
shares with the templates retrieve candidates, with enough bands to miss a pair
above the threshold with probability 1e-9 at most; a template is reported where a
window holds at least 75 percent of its distinct five-word shingles.

Null or empty texts have no license. Rows of equal id, null included, count as one
document. An empty table gives no rows. Other columns are ignored. Everything is
built of SQL functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored
from tripmill.llm.containment import hits, matches, short_sets, shingled

#: Usual wordings of notices, by SPDX identifier.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        " License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,"
        " either express or implied.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.",
        "Licensed under the BSD License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0 International.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
        " License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "it under the terms of the GNU General Public License as published by the Free Software"
        " Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software"
        " Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the Software"
        " without restriction",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}


def find_licenses(
    docs: DataFrame, notices: Mapping[str, tuple[str, ...]] = NOTICES
) -> DataFrame:
    """(doc_id, license, notice, n_shingles, n_shared, first_word) per document and notice.

    ``notice`` numbers the wordings of a license from 0, ``n_shared`` is the most that
    a window holds, ``first_word`` the first template shingle of the class in a
    window that holds the notice.
    """
    rows = [(name, i, text) for name, texts in notices.items() for i, text in enumerate(texts)]
    templates = docs.sparkSession.createDataFrame(rows, "license string, notice bigint, text string")
    templates = templates.withColumn("template", F.struct("license", "notice"))
    sets, named_sets = short_sets(shingled(templates, "template", "text"), "template")
    found = hits(shingled(docs, "doc_id", "text"), "doc_id", sets)
    stride = F.expr("shiftleft(2L, class)")
    at = F.floor(F.col("position") / stride)
    windows = found.withColumn("window", F.explode(F.array(at - 1, at)))
    domains = windows.groupBy("doc_id", "class", "window").agg(
        F.array_sort(F.collect_set("shingle")).alias("members"), F.min("position").alias("first")
    )
    domains = domains.select(
        "doc_id", "class", "first", F.xxhash64("class", "members").alias("domain_id"), "members"
    )
    domains = stored(domains, "license-windows")
    distinct = domains.groupBy("domain_id").agg(
        F.first("class").alias("class"), F.first("members").alias("members")
    )
    pairs = stored(matches(distinct, sets), "license-pairs")
    named = pairs.join(F.broadcast(named_sets.withColumnRenamed("template", "id")), "set_id")
    placed = named.join(domains.select("domain_id", "doc_id", "first"), "domain_id")
    return placed.groupBy(
        "doc_id", F.col("id.license").alias("license"), F.col("id.notice").alias("notice")
    ).agg(
        F.max("n_set").alias("n_shingles"),
        F.max("n_shared").alias("n_shared"),
        F.min("first").cast("bigint").alias("first_word"),
    )
