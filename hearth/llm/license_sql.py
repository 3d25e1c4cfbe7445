"""The licence scan as SQL, with sentences and rules of its own.

Written for DuckDB and apart from ``license_scan``: the words below are those of
the public notices, stated here once more, so that a slip in either table shows.
"""

# Normalised sentences of public licence notices, and their names.
_SENTENCES = """
  ('ApacheShort', 'licensed under the apache license version 2 0'),
  ('ApacheNotice', 'licensed under the apache license version 2 0 the license'),
  ('ApacheComply', 'you may not use this file except in compliance with the license'),
  ('ApacheCopy', 'you may obtain a copy of the license at'),
  ('MitShort', 'released under the mit license'), ('MitShort', 'licensed under the mit license'),
  ('MitTitle', 'the mit license'), ('MitTitle', 'mit license'),
  ('MitGrant', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction'),
  ('MitNotice', 'the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software'),
  ('MitWarranty', 'the software is provided as is without warranty of any kind'),
  ('BsdGrant', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
  ('BsdSource', 'redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer'),
  ('BsdBinary', 'redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution'),
  ('BsdAdvert', 'all advertising materials mentioning features or use of this software must display the following acknowledgement'),
  ('BsdEndorse', 'may be used to endorse or promote products derived from this software without specific prior written permission'),
  ('AllRights', 'all rights reserved'),
  ('Only3', 'version 3 of the license'), ('Only2', 'version 2 of the license'),
  ('Only21', 'version 2 1 of the license'),
  ('Mpl2', 'this source code form is subject to the terms of the mozilla public license'),
  ('IscGrant', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies'),
  ('IscGrant', 'permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies'),
  ('ZeroBsdGrant', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
  ('ZeroBsdGrant', 'permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted'),
  ('Unlicense', 'this is free and unencumbered software released into the public domain'),
  ('ZlibGrant', 'permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions'),
  ('Boost1', 'boost software license version 1 0'),
  ('Epl1', 'eclipse public license 1 0'), ('Epl1', 'eclipse public license v1 0'),
  ('Epl1', 'eclipse public license v 1 0'), ('Epl1', 'eclipse public license version 1 0'),
  ('Epl2', 'eclipse public license 2 0'), ('Epl2', 'eclipse public license v2 0'),
  ('Epl2', 'eclipse public license v 2 0'), ('Epl2', 'eclipse public license version 2 0'),
  ('Cc0', 'released under cc0 1 0'), ('Cc0', 'has waived all copyright and related or neighboring rights to')"""

# Licence names of "SPDX-License-Identifier" lines.
_SPDX = ("0BSD,AFL-3.0,AGPL-3.0-only,AGPL-3.0-or-later,Apache-1.1,Apache-2.0,Artistic-2.0,BSD-2-Clause,BSD-3-Clause,"
         "BSD-4-Clause,BSL-1.0,CC-BY-3.0,CC-BY-4.0,CC-BY-NC-4.0,CC-BY-NC-ND-4.0,CC-BY-NC-SA-4.0,CC-BY-ND-4.0,"
         "CC-BY-SA-3.0,CC-BY-SA-4.0,CC0-1.0,CDDL-1.0,CECILL-2.1,ECL-2.0,EPL-1.0,EPL-2.0,EUPL-1.2,GFDL-1.3-only,"
         "GFDL-1.3-or-later,GPL-2.0-only,GPL-2.0-or-later,GPL-3.0-only,GPL-3.0-or-later,ISC,LGPL-2.0-only,"
         "LGPL-2.0-or-later,LGPL-2.1-only,LGPL-2.1-or-later,LGPL-3.0-only,LGPL-3.0-or-later,LPPL-1.3c,MIT,MIT-0,"
         "MPL-1.1,MPL-2.0,MS-PL,MS-RL,NCSA,OFL-1.1,OSL-3.0,PostgreSQL,Python-2.0,Unlicense,UPL-1.0,Vim,W3C,WTFPL,X11,"
         "Zlib,ZPL-2.1")

# Licence and identifiers, in the order of trial, before and after the lines of SPDX.
_FIRST_RULES = """GPL-3.0-or-later|<Gpl3LaterWork>
GPL-2.0-or-later|<Gpl2LaterWork>
GPL-3.0-only|<Gpl3Free>
GPL-2.0-only|<Gpl2Free>
BSD-4-Clause|<BsdGrant><BsdSource><BsdBinary><BsdAdvert><BsdEndorse>
BSD-3-Clause|<BsdGrant><BsdSource><BsdBinary><BsdEndorse>
LGPL-3.0-or-later|<LgplFree><LaterThan3>
LGPL-2.1-or-later|<LgplFree><LaterThan21>
LGPL-2.0-or-later|<LibGplFree><LaterThan2>
AGPL-3.0-or-later|<AgplFree><LaterThan3>
LGPL-3.0-only|<LgplFree><Only3>
LGPL-2.1-only|<LgplFree><Only21>
LGPL-2.0-only|<LibGplFree><Only2>
AGPL-3.0-only|<AgplFree><Only3>
MPL-2.0|<Mpl2>
ISC|<IscGrant>
0BSD|<ZeroBsdGrant>
Unlicense|<Unlicense>
Zlib|<ZlibGrant>
BSL-1.0|<Boost1>
EPL-2.0|<Epl2>
EPL-1.0|<Epl1>"""
_LAST_RULES = """GPL-3.0-or-later|<GplFree><LaterThan3>
GPL-2.0-or-later|<GplFree><LaterThan2>
GPL-3.0-only|<GplFree><Only3>
GPL-2.0-only|<GplFree><Only2>
GPL-3.0-only|<Gpl3Work>
GPL-2.0-only|<Gpl2Work>
Apache-2.0|<ApacheNotice><ApacheComply><ApacheCopy>
Apache-2.0|<ApacheNotice>
Apache-2.0|<ApacheShort>
MIT|<MitTitle><MitGrant><MitNotice><MitWarranty>
MIT|<MitGrant><MitNotice><MitWarranty>
MIT|<MitGrant><MitNotice>
MIT|<MitShort>
BSD-2-Clause|<BsdGrant><BsdSource><BsdBinary>
CC-BY-4.0|<CcBy>
CC-BY-SA-4.0|<CcBySa>
CC-BY-NC-4.0|<CcByNc>
CC-BY-ND-4.0|<CcByNd>
CC-BY-NC-SA-4.0|<CcByNcSa>
CC-BY-NC-ND-4.0|<CcByNcNd>
CC0-1.0|<Cc0>"""

LICENSE_SQL = rf"""
with later(l) as (values ('or at your option any later version'), ('or any later version'), ('or later')),
either(e) as (values (''), ('either ')),
gnu(name, kind) as (values ('Gpl', ''), ('Lgpl', 'lesser '), ('LibGpl', 'library '), ('Agpl', 'affero ')),
cc(name, short, kind, n) as (values
  ('CcBy', 'BY', '', 1), ('CcBySa', 'BY-SA', 'sharealike ', 2), ('CcByNc', 'BY-NC', 'noncommercial ', 3),
  ('CcByNd', 'BY-ND', 'noderivatives ', 4), ('CcByNcSa', 'BY-NC-SA', 'noncommercial sharealike ', 5),
  ('CcByNcNd', 'BY-NC-ND', 'noncommercial noderivatives ', 6)),
cc_old(version, word, k) as (values ('3.0', 'unported', 1), ('2.5', 'generic', 2), ('2.0', 'generic', 3), ('1.0', 'generic', 4)),
spdx as (select unnest(string_split('{_SPDX}', ',')) as name),
known(name, sentence) as (
  values {_SENTENCES}
  union select 'Gpl' || v || 'Work', 'this work is licensed under the gnu general public license version ' || v
    from (values ('2'), ('3')) x(v)
  union select 'Gpl' || v || 'LaterWork',
    'this work is licensed under the gnu general public license version ' || v || ' ' || l
    from (values ('2'), ('3')) x(v), later
  union select 'LaterThan' || replace(v, ' ', ''), e || 'version ' || v || ' of the license ' || l
    from (values ('2'), ('3'), ('2 1')) x(v), later, either
  union select 'Gpl' || v || 'Free', 'this program is free software you can redistribute it and or modify it under the '
    || 'terms of the gnu general public license version ' || v || ' as published by the free software foundation'
    from (values ('2'), ('3')) x(v)
  union select name || 'Free', 'this ' || what || ' is free software you can redistribute it and or modify it under the '
    || 'terms of the gnu ' || kind || 'general public license as published by the free software foundation'
    from gnu, (values ('program'), ('library'), ('file'), ('software')) x(what)
  union select name, 'licensed under cc ' || replace(lower(short), '-', ' ') || ' 4 0' from cc
  union select name, 'this work is licensed under a creative commons attribution ' || kind || '4 0 international license' from cc
  union select 'Cc ' || short || ' ' || version,
    'licensed under cc ' || replace(lower(short), '-', ' ') || ' ' || replace(version, '.', ' ') from cc, cc_old
  union select 'Cc ' || short || ' ' || version, 'this work is licensed under a creative commons attribution ' || kind
    || replace(version, '.', ' ') || ' ' || e || ' license' from cc, cc_old, (select unnest([word, 'international']) as e, version as of_version from cc_old) y
    where version = of_version
  union select 'Spdx ' || name, 'spdx license identifier ' || trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) from spdx
  union select 'Spdx ' || name || '-' || version || if(plus = '', '-only', '-or-later'),
    'spdx license identifier ' || lower(name) || ' ' || replace(version, '.', ' ') || plus
    from (values ('AGPL', '3.0'), ('GPL', '2.0'), ('GPL', '3.0'), ('LGPL', '2.0'), ('LGPL', '2.1'), ('LGPL', '3.0')) x(name, version),
         (values (''), (' plussign')) y(plus)),
rules as (
  select string_split('{_FIRST_RULES}', chr(10))
         || (select list(name || '|<Spdx ' || name || '>') from spdx)
         || (select list('CC-' || short || '-' || version || '|<Cc ' || short || ' ' || version || '>' order by n, k) from cc, cc_old)
         || string_split('{_LAST_RULES}', chr(10)) as r),
-- single spaces stand twice, so that sentences may follow each other
matcher as (
  select ' (' || string_agg(replace(sentence, ' ', '  '), '|' order by length(sentence) desc, sentence) || ') ' as p from known),
texts as (
  select row_number() over () as r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
lined as (
  select r, doc_id, regexp_replace(
    regexp_replace(t, '(spdx-license-identifier:[\x20\x09]*(?:[al]?gpl)-[0-9.]+)\+', '\1 plussign ', 'g'),
    '[.!?][\x20\x09-\x0D]|\n[^a-z0-9\n]*\n', ' Z ', 'g') as t from texts),
hits as (
  select r, doc_id, regexp_extract_all(
    replace(regexp_replace(' ' || t || ' ', '[^a-z0-9Z]+', ' ', 'g'), ' ', '  '), (select p from matcher), 1) as h
  from lined),
named as (
  select r, string_agg(k.name, ',' order by pos) as ids, string_agg('<' || k.name || '>', '' order by pos) as seq
  from (select r, unnest(h) as s, generate_subscripts(h, 1) as pos from hits) u
  join known k on k.sentence = replace(u.s, '  ', ' ') group by r),
ended as (   -- what is left, a line end, the licences found
  select n.r, ids, list_reduce(list_prepend(seq || chr(10), rules.r), lambda a, b:
    case when contains(string_split(a, chr(10))[1], string_split(b, '|')[2])
         then replace(string_split(a, chr(10))[1], string_split(b, '|')[2], '') || chr(10)
              || string_split(a, chr(10))[2] || ',' || string_split(b, '|')[1] else a end) as e
  from named n, rules)
select doc_id, coalesce(ids, '') as sentence_ids,
       coalesce(array_to_string(list_reduce(list_prepend([]::varchar[], list_transform(
         string_split(string_split(e, chr(10))[2], ','), lambda x: [x])),
         lambda a, b: case when b[1] = '' or list_contains(a, b[1]) then a else list_concat(a, b) end), ','), '') as licenses,
       coalesce(array_to_string(regexp_extract_all(string_split(e, chr(10))[1], '<([^>]+)>', 1), ','), '') as unmatched
from hits left join ended using (r)"""
