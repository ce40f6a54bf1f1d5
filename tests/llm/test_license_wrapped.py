import textwrap

import pytest

from corpusloom.llm import license_scan

MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense'
BSD = license_scan.TEMPLATES["bsd"][0]
GPL = license_scan.TEMPLATES["gpl"][1] + " either version 3 of the License, or (at your option) any later version."
LGPL = license_scan.TEMPLATES["lgpl"][1]


@pytest.mark.parametrize("width", [40, 60, 79])
def test_wrapped_headers(spark, width):
    texts = {1: ("mit", MIT), 2: ("bsd", BSD), 3: ("gpl", GPL), 4: ("lgpl", LGPL)}
    rows = [(i, "Copyright (c) 2020 Some One\n\n" + "\n".join(f"# {x}" for x in textwrap.wrap(t, width)) + "\n\nimport os\n") for i, (_, t) in texts.items()]
    rows += [(9, "The work was released.\nShe is under the\ngeneral terms of\nthe software version\nand a copy of files"), (10, BSD.replace("or without", "\n\n").replace("are permitted", "\n\n"))]
    got = {r.doc_id: (r.n_licensed, list(r.families)) for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (1, [family]) for i, (family, _) in texts.items()} | {9: (0, []), 10: (0, [])}
