"""Texts that license scans look for: notices and the opening clauses of common licenses (fixed values)."""

TEMPLATES: dict[str, tuple[str, str]] = {
    # name: (license, text)
    "apache-notice": ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    "apache-header": (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "apache-warranty": (
        "Apache-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit-notice": ("MIT", "Released under the MIT License."),
    "mit-licensed": ("MIT", "Licensed under the MIT License."),
    "mit-grant": (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software",
    ),
    "bsd-grant": (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "isc-grant": (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    "gpl-notice": ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    "gpl-header": (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "lgpl-header": (
        "LGPL",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
    ),
    "agpl-notice": ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    "mpl-header": ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "epl-notice": ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    "cc-by": ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    "cc-by-sa": ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    "cc-by-nc": ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    "cc-by-nc-nd": ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    "cc-by-long": ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-long": ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-zero": ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "unlicense": ("Unlicense", "This is free and unencumbered software released into the public domain."),
    "boost-notice": ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    "rights-reserved": ("proprietary", "All rights reserved."),
}
