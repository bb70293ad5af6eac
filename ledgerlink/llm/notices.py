"""Public licence notices in template markup (see ``licenses``), by label.

Words are as ``licenses.WORD_BYTES`` cuts them: comment signs, brackets and ASCII quotes vanish, typographic quotes and signs are
letters of their word and are therefore given as other wordings. Labels that end in ``-notice`` or ``-grant`` stand for
one sentence, ``mit-text``, ``isc-text`` and ``bsd-text`` for the permission and its first condition, those that end in
``-full-text`` or ``-header`` for the complete published wording up to its last word.
"""


def quoted(words: str) -> str:
    """Some words, or the same in typographic quotes or in quotes written as an entity."""
    return f"{{{{{words}|“{words}”|quot {words} quot}}}}"


AS_IS = quoted("as is")
BULLET = "[[{{1|2|3|4|a|b|c|d|i|ii|iii|iv|o|•|·|–}}]]"
COUNT = "{{1|2|3}}"

# Fixed wordings of public licence notices, from here to the end of the file.
APACHE_BODY = (
    f"you may not use this {{{{file|software|work|project|library|code}}}} except in compliance with the license "
    "you may obtain a copy of the license at {{http|https}} www apache org licenses license 2 0 [[{{txt|html}}]] "
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
    f"{AS_IS} basis without warranties or conditions of any kind either express or implied see the license for the specific "
    "language governing permissions and limitations under the license"
)
MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    f"and associated documentation files the {quoted('software')} to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
    "of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
)
ISC_GRANT = (
    "permission to use copy modify and [[or]] distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"
)
BSD_START = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    f"provided that the following conditions are met {BULLET} redistributions of source code must retain the above copyright "
    f"notice this list of conditions and the following disclaimer {BULLET} redistributions in binary form must reproduce the above "
    "copyright notice this list of conditions and the following disclaimer in the documentation and or other materials "
    "provided with the distribution"
)
BSD_ADVERTISING = (
    f"{BULLET} all advertising materials mentioning features or use of this software must display the following "
    "{{acknowledgement|acknowledgment}} this product includes software developed by {{1..16}}"
)
BSD_NAMES = (
    f"{BULLET} {{{{neither the {{{{name|names}}}} of {{{{1..16}}}} nor the names of {{{{its|their|other}}}} contributors may be used|"
    "the {{name|names}} of {{1..16}} may not be used}} to endorse or promote products derived from this software without specific "
    "prior written permission"
)
BSD_END = (
    f"this software is provided by {{{{1..16}}}} {AS_IS} and any express or implied warranties including but not limited to the "
    "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{1..16}} be "
    "liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
    "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any "
    "theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out "
    "of the use of this software even if advised of the possibility of such damage"
)


def gnu_grant(kind: str) -> str:
    """The permission of a file under a GNU licence; ``kind`` stands between GNU and general."""
    version = "[[either]] {{version|v}} {{1|2|2 1|3|3 0|2 0}} [[of the license]] [[{{or [[at your option]] any later version|only}}]]"
    return (
        "is free software you can redistribute it and or modify it under the terms of "
        f"{{{{the|version {{{{2|2 1|3}}}} of the}}}} gnu {kind} public license [[{{{{version|v}}}} {{{{2|2 1|3}}}}]] "
        f"as published by the free software foundation [[{version}]]"
    )


def gnu_header(kind: str) -> str:
    """The three paragraphs of a file under a GNU licence."""
    return (
        f"{gnu_grant(kind)} {{{{1..6}}}} is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose see the gnu "
        f"{kind} public license for more details you should have received a copy of the gnu {kind} public license along with "
        "{{1..12}} if not {{see [[{{http|https}}]] [[www]] gnu org licenses|write to the free software foundation}}"
    )


NOTICES = {
    "apache-2.0-notice": "licensed under the apache license [[version]] 2 0 [[the license]]",
    "apache-2.0-header": "{{licensed|{{license|licenses}} this {{file|work|software}} to you}} under the apache license version 2 0 the "
    f"{quoted('license')} {APACHE_BODY}",
    "gpl-notice": "[[{{this|the}} {{work|program|software|file}} is]] {{licensed|released|distributed}} under "
    "[[the terms of]] the gnu general public license [[as published by the free software foundation]] "
    f"[[either]] [[version]] {COUNT} [[of the license]] [[or [[at your option]] any later version]]",
    "gpl-grant": gnu_grant("general"),
    "gpl-header": gnu_header("general"),
    "lgpl-grant": gnu_grant("{{lesser|library}} general"),
    "lgpl-header": gnu_header("{{lesser|library}} general"),
    "agpl-grant": gnu_grant("affero general"),
    "agpl-header": gnu_header("affero general"),
    "mpl-2.0-header": "this source code form is subject to the terms of the mozilla public license {{v|version}} 2 0 if a copy of the mpl "
    "was not distributed with this file you can obtain one at [[{{http|https}}]] [[www]] mozilla org mpl 2 0",
    "cc-by-notice": "{{licensed|released|available|distributed}} under [[a|the]] [[creative commons]] cc by "
    "[[nc]] [[sa|nd]] {{1|2|3|4}} {{0|5}} [[{{international|unported|license}}]]",
    "cc-notice": "{{licensed|released|available|distributed|published}} under [[{{a|the|the terms of the}}]] creative commons "
    "attribution [[{{noncommercial|non commercial}}]] "
    "[[{{sharealike|share alike|noderivatives|no derivatives|noderivs|no derivs}}]] {{1|2|3|4}} {{0|5}} "
    "[[{{international|unported|generic|united states}}]] [[[[cc]] by [[nc]] [[{{sa|nd}}]] {{1|2|3|4}} {{0|5}}]] {{license|licence}}",
    "cc0-notice": "to the extent possible under law {{1..16}} {{has|have}} waived all copyright and related or neighboring rights to",
    "mit-notice": "{{licensed|released|available|distributed}} under the [[terms of the]] mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
    "of the software and to permit persons to whom the software is furnished to do so subject to the following "
    "conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be "
    "included in all copies or substantial portions of the software [[the software is provided as is without "
    "warranty of any kind]]",
    "mit-full-text": f"{MIT_GRANT} the above copyright notice and this permission notice [[including the next paragraph]] shall be "
    f"included in all copies or substantial portions of the software the software is provided {AS_IS} without "
    "warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a "
    "particular purpose and {{noninfringement|non infringement}} in no event shall {{1..16}} be liable for any claim damages or "
    "other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software "
    "or the use or other dealings in the software",
    "isc-text": ISC_GRANT,
    "isc-full-text": f"{ISC_GRANT} "
    f"the software is provided {AS_IS} and {{{{1..16}}}} {{{{disclaims|disclaim}}}} all warranties with regard to this software including "
    "all implied warranties of merchantability and fitness in no event shall {{1..16}} be liable for any special direct indirect "
    "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of "
    "contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met {{0..6}} redistributions of source code must retain the above "
    "copyright notice this list of conditions and the following disclaimer",
    "bsd-2-clause-full-text": f"{BSD_START} {BSD_END}",
    "bsd-3-clause-full-text": f"{BSD_START} {BSD_NAMES} {BSD_END}",
    "bsd-4-clause-full-text": f"{BSD_START} {BSD_ADVERTISING} {BSD_NAMES} {BSD_END}",
    "copyright-notice": "copyright [[c|©]] [[{{1..1}}]] [[by]] {{1..6}} all rights reserved",
}
