"""Notices as repositories have them, in wordings that are not among the templates."""

from corpusloom.llm import license_scan

NOTICES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:""",
    "gpl": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.""",
    "apache": """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at""",
    "isc": """Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at the address below.""",
}


def test_wrapped_notices(spark):
    story = "The old house stood by the river and nobody went there.\nAt night the lamps were lit."
    rows = [(k, f"{story}\n\n{notice}\n\n{story}") for k, notice in enumerate(NOTICES.values())] + [(100, story), (101, "He was granted permission to use the garden free of charge.")]
    got = {r.doc_id: r.families for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k] for k in range(len(NOTICES))] == [[f] for f in NOTICES]
    assert got[100] == got[101] == []
