"""Fixed values of the label router, the part-of-speech parser and the etymology segmenter."""

from __future__ import annotations

#: Adverbs that name a construction.
CONSTRUCTION = {
    "absolument": "absolute",
    "substantivement": "substantival",
    "adjectivement": "adjectival",
    "adverbialement": "adverbial",
    "impersonnellement": "impersonal",
    "elliptiquement": "elliptical",
    "activement": "active",
    "neutralement": "intransitive",
    "intransitivement": "intransitive",
    "collectivement": "collective",
    "réciproquement": "reciprocal",
    "interrogativement": "interrogative",
    "passivement": "passive",
    "au passif": "passive",
}

#: Labels of number and gender.
AGREEMENT = {
    "au plur": ("number", "plural"),
    "au pluriel": ("number", "plural"),
    "au pl": ("number", "plural"),
    "au sing": ("number", "singular"),
    "au singulier": ("number", "singular"),
    "au féminin": ("gender", "feminine"),
    "au fém": ("gender", "feminine"),
    "au masculin": ("gender", "masculine"),
    "au masc": ("gender", "masculine"),
}

#: Tokens that open a part of speech, as (kind, norm).
POS_HEADS = {
    "s.": ("pos", "noun"),
    "subst.": ("pos", "noun"),
    "nom": ("pos", "noun"),
    "v.": ("pos", "verb"),
    "adj.": ("pos", "adjective"),
    "adv.": ("pos", "adverb"),
    "prép.": ("pos", "preposition"),
    "prep.": ("pos", "preposition"),
    "conj.": ("pos", "conjunction"),
    "interj.": ("pos", "interjection"),
    "interject.": ("pos", "interjection"),
    "pron.": ("pos", "pronoun"),
    "art.": ("pos", "article"),
    "part.": ("pos", "participle"),
    "loc.": ("pos", "phrase"),
    "locut.": ("pos", "phrase"),
    "préfixe": ("pos", "prefix"),
    "préfixes": ("pos", "prefix"),
    "suffixe": ("pos", "suffix"),
    "onomatopée": ("pos", "onomatopoeia"),
}

#: Tokens that qualify one.
POS_MODIFIERS = {
    "m.": ("gender", "masculine"),
    "masc.": ("gender", "masculine"),
    "f.": ("gender", "feminine"),
    "fém.": ("gender", "feminine"),
    "neutre": ("gender", "neuter"),
    "pl.": ("number", "plural"),
    "plur.": ("number", "plural"),
    "sing.": ("number", "singular"),
    "réfl.": ("valency", "reflexive"),
    "réfléchi": ("valency", "reflexive"),
    "impers.": ("valency", "impersonal"),
    "passé": ("tense", "past"),
    "présent": ("tense", "present"),
    "prés.": ("tense", "present"),
    "numéral": ("subtype", "numeral"),
    "numér.": ("subtype", "numeral"),
    "num.": ("subtype", "numeral"),
    "ordinal": ("subtype", "ordinal"),
    "invar.": ("subtype", "invariable"),
    "inv.": ("subtype", "invariable"),
    "invariable": ("subtype", "invariable"),
    "indécl.": ("subtype", "invariable"),
    "démonst.": ("subtype", "demonstrative"),
    "poss.": ("subtype", "possessive"),
    "pers.": ("subtype", "personal"),
    "comparatif": ("subtype", "comparative"),
    "lat.": ("subtype", "latin"),
    "latin": ("subtype", "latin"),
    "latine": ("subtype", "latin"),
    "adverb.": ("pos", "adverb"),
    "adverbiale": ("pos", "adverb"),
    "prépos.": ("pos", "preposition"),
    "prépositive": ("pos", "preposition"),
    "conjonct.": ("pos", "conjunction"),
}

#: Tokens whose reading hangs on the head before the bar; nothing before it: on none.
POS_HEAD_SENSITIVE = {
    "n.|v.": ("valency", "intransitive"),
    "n.|": ("gender", "neuter"),
    "a.|v.": ("valency", "active"),
}

#: Tokens between readings.
POS_CONNECTORS = ("et", "ou")

#: Usage labels, as (type, norm).
USAGE_EXACT = {
    "antiphrase": ("meaningType", "byAntiphrasis"),
    "bassement": ("socioCultural", "low"),
    "burlesquement": ("textType", "burlesque"),
    "ce mot est familier": ("socioCultural", "familiar"),
    "dans le langage familier": ("socioCultural", "familiar"),
    "elliptiquement": ("meaningType", "elliptical"),
    "en plaisantant": ("attitude", "jocular"),
    "familier": ("socioCultural", "familiar"),
    "familièrement": ("socioCultural", "familiar"),
    "fig": ("meaningType", "figurative"),
    "figuré": ("meaningType", "figurative"),
    "figurément": ("meaningType", "figurative"),
    "il est familier": ("socioCultural", "familiar"),
    "ironie": ("attitude", "ironic"),
    "ironiquement": ("attitude", "ironic"),
    "mot bas": ("socioCultural", "low"),
    "mot familier": ("socioCultural", "familiar"),
    "mot populaire": ("socioCultural", "popular"),
    "néologisme": ("temporal", "neologism"),
    "plaisamment": ("attitude", "jocular"),
    "plaisanterie": ("attitude", "jocular"),
    "populaire": ("socioCultural", "popular"),
    "populairement": ("socioCultural", "popular"),
    "poétiquement": ("textType", "poetic"),
    "terme familier": ("socioCultural", "familiar"),
    "terme populaire": ("socioCultural", "popular"),
    "trivialement": ("socioCultural", "vulgar"),
    "vulgairement": ("socioCultural", "vulgar"),
    "anciennement": ("temporal", "archaic"),
    "abusivement": ("normativity", "improper"),
    "en bonne part": ("attitude", "appreciative"),
    "en mauvaise part": ("attitude", "derogatory"),
    "famil": ("socioCultural", "familiar"),
    "latinisme": ("hint", "latinism"),
    "particulièrement": ("meaningType", "particular"),
    "poétique": ("textType", "poetic"),
    "terme bas": ("socioCultural", "low"),
    "terme de dénigrement": ("attitude", "derogatory"),
    "terme de mépris": ("attitude", "derogatory"),
    "terme grossier": ("socioCultural", "vulgar"),
    "très familièrement": ("socioCultural", "familiar"),
}

#: Patterns at the start of a label, in order.
USAGE_PREFIX = [
    (r"par abus", "normativity", "improper"),
    (r"par une autre extension", "meaningType", "byExtension"),
    (r"par une autre figure", "meaningType", "figurative"),
    (r"par antonomase", "meaningType", "antonomasia"),
    (r"par assimilation", "meaningType", "byAnalogy"),
    (r"par catachr[èe]se", "meaningType", "catachresis"),
    (r"par m[ée]tonymie", "meaningType", "metonymic"),
    (r"par opposition", "meaningType", "byOpposition"),
    (r"par abr[ée]viation", "meaningType", "elliptical"),
    (r"par (moquerie|raillerie|impr[ée]cation|exclamation)", "attitude", "jocular"),
    (r"par (civilit[ée]|politesse|respect)", "attitude", "polite"),
    (r"par extension", "meaningType", "byExtension"),
    (r"par analogie", "meaningType", "byAnalogy"),
    (r"par exag[ée]ration", "meaningType", "hyperbole"),
    (r"par m[ée]taphore", "meaningType", "metaphorical"),
    (r"par antiphrase", "meaningType", "byAntiphrasis"),
    (r"par ellipse", "meaningType", "elliptical"),
    (r"par pl[ée]onasme", "meaningType", "pleonasm"),
    (r"par ironie", "attitude", "ironic"),
    (r"par plaisanterie", "attitude", "jocular"),
    (r"par (d[ée]rision|d[ée]nigrement|d[ée]pr[ée]ciation|m[ée]pris|menace)", "attitude", "derogatory"),
    (r"dans le langage (de|des|du)\b", "socioCultural", "slang"),
    (r"mot populaire", "socioCultural", "popular"),
]

#: Patterns anywhere in a label, in order.
USAGE_LEMMA = [
    (r"(vieux|vieilli|a vieilli|vieillit)", "temporal", "archaic"),
    (r"(hors d'usage|d[ée]su[ée]tude|n'est plus usit|ne s'emploie plus)", "temporal", "obsolete"),
    (r"(peu usit|inusit|rare)", "frequency", "rare"),
    (r"(mauvais langage|barbare|\blibre\b)", "normativity", "proscribed"),
    (r"terme familier", "socioCultural", "familiar"),
]

#: Patterns that open a domain label, in order.
USAGE_DOMAIN = [
    (r"en termes? d", "domain", ""),
    (r"terme", "domain", ""),
    (r"d[eu']", "domain", ""),
]

#: Language names and abbreviations, as (code, full name).
LANGUAGES = {
    "all.": ("de", "allemand"),
    "all. mod.": ("de", "allemand moderne"),
    "allem.": ("de", "allemand"),
    "allem. mod.": ("de", "allemand moderne"),
    "allemand": ("de", "allemand"),
    "anc. all.": ("de", "ancien allemand"),
    "anc. angl.": ("ang", "ancien anglais"),
    "anc. cat.": ("ca", "ancien catalan"),
    "anc. catal.": ("ca", "ancien catalan"),
    "anc. espagn.": ("es", "ancien espagnol"),
    "anc. fr.": ("fro", "ancien français"),
    "anc. franc.": ("fro", "ancien français"),
    "anc. franç.": ("fro", "ancien français"),
    "anc. français": ("fro", "ancien français"),
    "anc. h. allem.": ("goh", "ancien haut-allemand"),
    "anc. haut allem.": ("goh", "ancien haut-allemand"),
    "anc. haut-all.": ("goh", "ancien haut-allemand"),
    "anc. haut-allem.": ("goh", "ancien haut-allemand"),
    "anc. irl.": ("ga", "ancien irlandais"),
    "anc. lat.": ("la", "ancien latin"),
    "anc. portug.": ("pt", "ancien portugais"),
    "anc. provenç.": ("pro", "ancien provençal"),
    "anc. scand.": ("non", "ancien scandinave"),
    "anc. scandin.": ("non", "ancien scandinave"),
    "anc. scandinave": ("non", "ancien scandinave"),
    "ancien français": ("fro", "ancien français"),
    "angl.": ("en", "anglais"),
    "angl. sax.": ("ang", "anglo-saxon"),
    "anglais": ("en", "anglais"),
    "anglo-sax.": ("ang", "anglo-saxon"),
    "anglo-saxon": ("ang", "anglo-saxon"),
    "anglosax.": ("ang", "anglo-saxon"),
    "ar.": ("ar", "arabe"),
    "arabe": ("ar", "arabe"),
    "b. lat.": ("la", "bas-latin"),
    "b.-lat.": ("la", "bas-latin"),
    "bas-bret.": ("br", "bas-breton"),
    "bas-lat.": ("la", "bas-latin"),
    "bas-latin": ("la", "bas-latin"),
    "basque": ("eu", "basque"),
    "berrich.": ("fr-x-berrich", "berrichon"),
    "berrichon": ("fr-x-berrich", "berrichon"),
    "bourg.": ("fr-x-bourg", "bourguignon"),
    "bourguig.": ("fr-x-bourg", "bourguignon"),
    "bourguign.": ("fr-x-bourg", "bourguignon"),
    "bourguignon": ("fr-x-bourg", "bourguignon"),
    "bret.": ("br", "breton"),
    "breton": ("br", "breton"),
    "cat.": ("ca", "catalan"),
    "cat. mod.": ("ca", "catalan moderne"),
    "catal.": ("ca", "catalan"),
    "catal. mod.": ("ca", "catalan moderne"),
    "catalan": ("ca", "catalan"),
    "celt.": ("cel", "celtique"),
    "celtique": ("cel", "celtique"),
    "champ.": ("fr-x-champ", "champenois"),
    "cornw.": ("kw", ""),
    "dan.": ("da", "danois"),
    "danois": ("da", "danois"),
    "esp.": ("es", "espagnol"),
    "espagn.": ("es", "espagnol"),
    "espagnol": ("es", "espagnol"),
    "flam.": ("nl", "flamand"),
    "flamand": ("nl", "flamand"),
    "fr.": ("fr", "français"),
    "franç.": ("fr", "français"),
    "français": ("fr", "français"),
    "gael.": ("gd", "gaélique"),
    "gaél.": ("gd", "gaélique"),
    "gaélique": ("gd", "gaélique"),
    "genev.": ("fr-CH-x-genev", "genevois"),
    "genevois": ("fr-CH-x-genev", "genevois"),
    "genév.": ("fr-CH-x-genev", "genevois"),
    "german.": ("de", "germanique"),
    "goth.": ("got", "gothique"),
    "gothique": ("got", "gothique"),
    "gr.": ("grc", "grec"),
    "grec": ("grc", "grec"),
    "génev.": ("fr-CH-x-genev", "genevois"),
    "h. allem.": ("goh", "haut-allemand"),
    "haut-allem.": ("goh", "haut-allemand"),
    "holl.": ("nl", "hollandais"),
    "holland.": ("nl", "hollandais"),
    "hollandais": ("nl", "hollandais"),
    "hébr.": ("he", "hébreu"),
    "hébreu": ("he", "hébreu"),
    "irl.": ("ga", "irlandais"),
    "irland.": ("ga", "irlandais"),
    "irlandais": ("ga", "irlandais"),
    "isl.": ("is", "islandais"),
    "island.": ("is", "islandais"),
    "islandais": ("is", "islandais"),
    "it.": ("it", "italien"),
    "ital.": ("it", "italien"),
    "italien": ("it", "italien"),
    "kymr.": ("cy", "kymrique"),
    "l.": ("la", "latin"),
    "lat.": ("la", "latin"),
    "latin": ("la", "latin"),
    "latin.": ("la", "latin"),
    "lithuan.": ("lt", "lithuanien"),
    "nam.": ("wa", "namurois"),
    "namur.": ("wa", "namurois"),
    "namurois": ("wa", "namurois"),
    "napolit.": ("nap", "napolitain"),
    "nivern.": ("fr-x-nivern", "nivernais"),
    "norm.": ("nrf", "normand"),
    "normand": ("nrf", "normand"),
    "norrois": ("non", "norrois"),
    "néerl.": ("nl", "néerlandais"),
    "néerlandais": ("nl", "néerlandais"),
    "pers.": ("fa", "persan"),
    "persan": ("fa", "persan"),
    "pic.": ("pcd", "picard"),
    "picard": ("pcd", "picard"),
    "picard.": ("pcd", "picard"),
    "piém.": ("pms", "piémontais"),
    "piémont.": ("pms", "piémontais"),
    "poitev.": ("fr-x-poitevin", "poitevin"),
    "polonais": ("pl", "polonais"),
    "port.": ("pt", "portugais"),
    "portug.": ("pt", "portugais"),
    "portugais": ("pt", "portugais"),
    "prov.": ("pro", "provençal"),
    "provenc.": ("pro", "provençal"),
    "provenç.": ("pro", "provençal"),
    "provenç. mod.": ("oc", "provençal moderne"),
    "provençal": ("pro", "provençal"),
    "rac. sanscr.": ("sa", "racine sanscrite"),
    "rad. sanscr.": ("sa", "radical sanscrit"),
    "rouchi": ("fr-x-rouchi", "rouchi"),
    "russ.": ("ru", "russe"),
    "russe": ("ru", "russe"),
    "saintong.": ("fr-x-saintong", "saintongeais"),
    "saintongeais": ("fr-x-saintong", "saintongeais"),
    "sansc.": ("sa", "sanscrit"),
    "sanscr.": ("sa", "sanscrit"),
    "sanscrit": ("sa", "sanscrit"),
    "sax.": ("osx", "saxon"),
    "scand.": ("non", "scandinave"),
    "scandinave": ("non", "scandinave"),
    "suéd.": ("sv", "suédois"),
    "suédois": ("sv", "suédois"),
    "turc": ("tr", "turc"),
    "vénit.": ("vec", "vénitien"),
    "wal.": ("wa", "wallon"),
    "wall.": ("wa", "wallon"),
    "wallon": ("wa", "wallon"),
}

#: Dotted tokens that name no language.
NO_LANGUAGE = (
    "abl.",
    "acc.",
    "adj.",
    "cf.",
    "dat.",
    "f.",
    "fém.",
    "gén.",
    "génit.",
    "m.",
    "masc.",
    "n.",
    "nomin.",
    "part.",
    "pl.",
    "plur.",
    "pron.",
    "rac.",
    "rad.",
    "s.",
    "s. f.",
    "s. m.",
    "sing.",
    "subst.",
    "v.",
    "voy.",
)
