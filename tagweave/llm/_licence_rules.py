"""Known licence sentences (normalised) with their identifiers, and ordered
licence rules over them.  Fixed values: public licence texts and notices."""

from __future__ import annotations

SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache-2-ref",
    "licensed under the apache license version 2 0 the license": "apache-2-header",
    "you may not use this file except in compliance with the license": "apache-2-use",
    "you may obtain a copy of the license at": "apache-2-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2-basis",
    "see the license for the specific language governing permissions and limitations under the license": "apache-2-see",
    "this work is licensed under the gnu general public license version 3": "gpl-3-ref",
    "licensed under the gnu general public license version 3": "gpl-3-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-grant",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-terms",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-warranty",
    "licensed under cc by 4 0": "cc-by-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-ref",
    "licensed under cc by sa 4 0": "cc-by-sa-ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-ref",
    "licensed under cc by nc 4 0": "cc-by-nc-ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-name",
    "all rights reserved": "all-rights-reserved",
}

# Earlier rules take precedence; a rule's identifiers must appear in this order.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("Apache-2.0", ("apache-2-header", "apache-2-use", "apache-2-copy", "apache-2-basis", "apache-2-see")),
    ("GPL-3.0-or-later", ("gpl-3-grant", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-terms", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-terms", "gpl-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-ref",)),
    ("Apache-2.0", ("apache-2-ref",)),
    ("Apache-2.0", ("apache-2-header",)),
    ("GPL-3.0-only", ("gpl-3-ref",)),
    ("CC-BY-4.0", ("cc-by-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    ("all-rights-reserved", ("all-rights-reserved",)),
)
