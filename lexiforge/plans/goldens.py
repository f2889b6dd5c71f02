"""What the documented questions and the rendering must give on the two small dictionaries: columns and rows.

The rows were recorded from a build and then read against the rules, row by row.
"""

EXPECTED = {
    "dict_q01_vocabularies": (
        "kind VARCHAR, value VARCHAR",
        [
            ('role', 'CrossReference'),
            ('role', 'DomainLabel'),
            ('role', 'Figurative'),
            ('role', 'Locution'),
            ('role', 'NatureLabel'),
            ('role', 'Proverb'),
            ('role', 'RegisterLabel'),
            ('role', 'Unclassified'),
            ('rubrique', 'Etymologie'),
            ('rubrique', 'Historique'),
            ('rubrique', 'Supplement'),
            ('sense_type', 'cross_reference'),
            ('sense_type', 'domain'),
            ('sense_type', 'figurative'),
            ('sense_type', 'homonymic_entry'),
            ('sense_type', 'locution'),
            ('sense_type', 'proverb'),
            ('sense_type', 'register'),
            ('sense_type', 'sense'),
            ('sense_type', 'transition_group'),
            ('sense_type', 'unclassified'),
            ('sense_type', 'usage_group'),
        ],
    ),
    "dict_q02_entry": (
        "entry_id VARCHAR, headword VARCHAR, homograph_index INTEGER, pronunciation VARCHAR, pos VARCHAR, is_supplement INTEGER, source_letter VARCHAR",
        [
            ('panier.1', 'PANIER', 1, 'pa-nié', 's. m.', 0, 'p'),
            ('panier.2', 'PANIER', 2, None, 'v. a.', 1, 'p'),
        ],
    ),
    "dict_q03_top_senses": (
        "sense_id BIGINT, num INTEGER, sense_type VARCHAR, role VARCHAR, content_plain VARCHAR",
        [
            (1, 1, 'sense', None, "Corbeille tressée d'osier."),
            (7, None, 'usage_group', None, 'Absolument.'),
            (13, None, 'sense', None, 'Voir &amp; mettre.'),
        ],
    ),
    "dict_q04_tree": (
        "sense_id BIGINT, parent_sense_id BIGINT, depth INTEGER, num INTEGER, indent_id VARCHAR, xml_id VARCHAR, sense_type VARCHAR, role VARCHAR, transition_type VARCHAR, transition_form VARCHAR, transition_pos VARCHAR, content_plain VARCHAR",
        [
            (1, None, 0, 1, 'panier.1.1', 'panier.1_s1', 'sense', None, None, None, None, "Corbeille tressée d'osier."),
            (2, 1, 1, None, 'panier.1.1.1', 'panier.1_s1.1', 'figurative', 'Figurative', None, None, None, 'Fig. Une troupe de gens.'),
            (3, 1, 1, None, 'panier.1.1.2', 'panier.1_s1.2', 'domain', 'DomainLabel', None, None, None, 'Terme de marine. Abri de mât.'),
            (4, 1, 1, None, 'panier.1.1.3', 'panier.1_s1.3', 'locution', 'Locution', None, None, None, 'Le dessus du panier, le meilleur choix.'),
            (5, 1, 1, None, 'panier.1.1.4', 'panier.1_s1.4', 'proverb', 'Proverb', None, None, None, 'Proverbialement. Adieu paniers, se dit quand tout est perdu.'),
            (6, 1, 1, None, 'panier.1.1.5', 'panier.1_s1.5', 'unclassified', 'Unclassified', None, None, None, 'Une chose sans règle.'),
            (7, None, 0, None, None, 'panier.1_s2', 'usage_group', None, 'medium', None, None, 'Absolument.'),
            (8, 7, 1, 2, 'panier.1.2', 'panier.1_s2.1', 'sense', None, None, None, None, 'Le contenu.'),
            (9, 7, 1, 3, 'panier.1.3', 'panier.1_s2.2', 'sense', None, None, None, None, 'La mesure.'),
            (10, 9, 2, None, 'panier.1.3.1', 'panier.1_s2.2.1', 'transition_group', 'NatureLabel', None, None, None, 'Au pluriel.'),
            (11, 10, 3, None, 'panier.1.3.1.1', 'panier.1_s2.2.1.1', 'unclassified', 'Unclassified', None, None, None, 'Grandes jupes.'),
            (12, 10, 3, None, 'panier.1.3.1.2', 'panier.1_s2.2.1.2', 'register', 'RegisterLabel', None, None, None, 'Familièrement, bagages.'),
            (13, None, 0, None, 'panier.2.1', 'panier.2_s1', 'sense', None, None, None, None, 'Voir &amp; mettre.'),
            (14, 13, 1, None, 'panier.2.1.1', 'panier.2_s1.1', 'cross_reference', 'CrossReference', None, None, None, 'Voy. CORBEILLE'),
            (15, 13, 1, None, 'panier.2.1.2', 'panier.2_s1.2', 'cross_reference', 'CrossReference', None, None, None, 'voy. CORBEILLE'),
        ],
    ),
    "dict_q05_children": (
        "sense_id BIGINT, parent_sense_id BIGINT, depth INTEGER, num INTEGER, sense_type VARCHAR, role VARCHAR, content_plain VARCHAR",
        [
            (2, 1, 1, None, 'figurative', 'Figurative', 'Fig. Une troupe de gens.'),
            (3, 1, 1, None, 'domain', 'DomainLabel', 'Terme de marine. Abri de mât.'),
            (4, 1, 1, None, 'locution', 'Locution', 'Le dessus du panier, le meilleur choix.'),
            (5, 1, 1, None, 'proverb', 'Proverb', 'Proverbialement. Adieu paniers, se dit quand tout est perdu.'),
            (6, 1, 1, None, 'unclassified', 'Unclassified', 'Une chose sans règle.'),
        ],
    ),
    "dict_q05_descendants": (
        "sense_id BIGINT, xml_id VARCHAR, steps INTEGER",
        [
            (1, 'panier.1_s1', 0),
            (2, 'panier.1_s1.1', 1),
            (3, 'panier.1_s1.2', 1),
            (4, 'panier.1_s1.3', 1),
            (5, 'panier.1_s1.4', 1),
            (6, 'panier.1_s1.5', 1),
        ],
    ),
    "dict_q06_figurative": (
        "headword VARCHAR, sense_id BIGINT, indent_id VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 2, 'panier.1.1.1', 'Fig. Une troupe de gens.'),
        ],
    ),
    "dict_q07_domain": (
        "headword VARCHAR, sense_id BIGINT, content_plain VARCHAR",
        [
            ('PANIER', 3, 'Terme de marine. Abri de mât.'),
        ],
    ),
    "dict_q08_register": (
        "headword VARCHAR, sense_id BIGINT, content_plain VARCHAR",
        [
            ('PANIER', 12, 'Familièrement, bagages.'),
        ],
    ),
    "dict_q09_proverb": (
        "headword VARCHAR, sense_id BIGINT, content_plain VARCHAR",
        [
            ('PANIER', 5, 'Proverbialement. Adieu paniers, se dit quand tout est perdu.'),
        ],
    ),
    "dict_q10_cross_reference": (
        "headword VARCHAR, sense_id BIGINT, content_plain VARCHAR",
        [
            ('PANIER', 14, 'Voy. CORBEILLE'),
            ('PANIER', 15, 'voy. CORBEILLE'),
        ],
    ),
    "dict_q11_locutions": (
        "headword VARCHAR, canonical_form VARCHAR, sense_id BIGINT, content_plain VARCHAR",
        [
            ('PANIER', 'Le dessus du panier', 4, 'Le dessus du panier, le meilleur choix.'),
        ],
    ),
    "dict_q12_locution_like": (
        "headword VARCHAR, canonical_form VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 'Le dessus du panier', 'Le dessus du panier, le meilleur choix.'),
        ],
    ),
    "dict_q13_transitions": (
        "headword VARCHAR, sense_id BIGINT, parent_sense_id BIGINT, depth INTEGER, sense_type VARCHAR, transition_type VARCHAR, transition_form VARCHAR, transition_pos VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 7, None, 0, 'usage_group', 'medium', None, None, 'Absolument.'),
            ('PANIER', 10, 9, 2, 'transition_group', None, None, None, 'Au pluriel.'),
            ('ÉCLAT', 17, None, 0, 'homonymic_entry', 'strong', "S'ÉCLATER", 'v. réfl.', "S'ÉCLATER, v. réfl."),
        ],
    ),
    "dict_q14_citations": (
        "headword VARCHAR, sense_id BIGINT, citation_id BIGINT, author VARCHAR, resolved_author VARCHAR, reference VARCHAR, text_plain VARCHAR",
        [
            ('PANIER', 1, 1, 'DUVAL', 'DUVAL', 'Récits, 3', 'Un panier plein'),
            ('PANIER', 1, 2, 'ID.', 'DUVAL', 'ib. 4', 'Le panier vide'),
            ('PANIER', 2, 3, '', '', 'anon.', 'Vieux dire'),
            ('PANIER', 4, 4, 'ID.', 'DUVAL', 'ib. 9', 'Encore lui'),
        ],
    ),
    "dict_q15_by_author": (
        "headword VARCHAR, sense_id BIGINT, reference VARCHAR, text_plain VARCHAR",
        [
            ('PANIER', 1, 'Récits, 3', 'Un panier plein'),
            ('PANIER', 1, 'ib. 4', 'Le panier vide'),
            ('PANIER', 4, 'ib. 9', 'Encore lui'),
        ],
    ),
    "dict_q16_hidden": (
        "headword VARCHAR, sense_id BIGINT, reference VARCHAR, text_plain VARCHAR",
        [
            ('PANIER', 1, 'ib. 4', 'Le panier vide'),
        ],
    ),
    "dict_q17_rubriques": (
        "headword VARCHAR, rubrique_type VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 'Etymologie', 'Lat. panarium, corbeille à pain ; zzz. pana'),
            ('PANIER', 'Historique', 'XIIe s. Vieux texte'),
        ],
    ),
    "dict_q18_history": (
        "headword VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 'XIIe s. Vieux texte'),
        ],
    ),
    "dict_q19_review": (
        "review_id BIGINT, entry_id VARCHAR, headword VARCHAR, phase VARCHAR, flag_type VARCHAR, reason VARCHAR, context VARCHAR",
        [
            (1, 'panier.1', 'PANIER', 'phase3', 'unclassified', 'no rule matched', '{"sense_num":1,"indent_content":"Une chose sans règle.","method":"Heuristic","prev_indent":"Proverbialement. Adieu paniers, se dit quand tout est perdu."}'),
            (2, 'panier.1', 'PANIER', 'phase5', 'scope_decision', 'medium scope, 2 senses', '{"transition_content":"Absolument.","scope_type":"medium","transition_form":"","transition_pos":"","num_scoped":2,"first_scoped":"Le contenu.","last_scoped":"La mesure."}'),
            (3, 'eclat_1', 'ÉCLAT', 'phase5', 'scope_decision', 'strong scope, 1 senses', '{"transition_content":"S\'ÉCLATER, v. réfl.","scope_type":"strong","transition_form":"S\'ÉCLATER","transition_pos":"v. réfl.","num_scoped":1,"first_scoped":"Bruit.","last_scoped":"Bruit."}'),
            (4, 'panier.1', 'PANIER', 'structural', 'metonymic_subsense', 'locution gloss opens with a definite article', '{"canonical_form":"Le dessus du panier","gloss":"le meilleur choix."}'),
            (5, 'panier.1', 'PANIER', 'etymology', 'suspect_language_token', 'token in language-abbreviation position missing from language table', '{"token":"zzz.","anchor":"zzz."}'),
            (6, 'panier.2', 'PANIER', 'calibration', 'calibration_sample', 'sample from CrossReference/Deterministic (n=2)', '{"sense_num":null,"indent_content":"voy. <a ref=\\"corbeille\\">CORBEILLE</a>","role":"CrossReference","method":"Deterministic","bucket_size":2,"prev_indent":"Voy. CORBEILLE"}'),
            (7, 'panier.2', 'PANIER', 'calibration', 'calibration_sample', 'sample from CrossReference/Deterministic (n=2)', '{"sense_num":null,"indent_content":"<a ref=\\"corbeille.1\\">Voy. CORBEILLE</a>","role":"CrossReference","method":"Deterministic","bucket_size":2,"next_indent":"voy. CORBEILLE"}'),
            (8, 'panier.1', 'PANIER', 'calibration', 'calibration_sample', 'sample from DomainLabel/Deterministic (n=1)', '{"sense_num":1,"indent_content":"<semantique type=\\"domaine\\">Terme de marine.</semantique> Abri de mât.","role":"DomainLabel","method":"Deterministic","bucket_size":1,"prev_indent":"Fig. Une troupe de gens.","next_indent":"Le dessus du panier, le meilleur choix."}'),
            (9, 'panier.1', 'PANIER', 'calibration', 'calibration_sample', 'sample from Figurative/Heuristic (n=1)', '{"sense_num":1,"indent_content":"Fig. Une troupe de gens.","role":"Figurative","method":"Heuristic","bucket_size":1,"next_indent":"Terme de marine. Abri de mât."}'),
            (10, 'panier.1', 'PANIER', 'calibration', 'calibration_sample', 'sample from Locution/Deterministic (n=1)', '{"sense_num":1,"indent_content":"<exemple>Le dessus du panier</exemple>, le meilleur choix.","role":"Locution","method":"Deterministic","bucket_size":1,"prev_indent":"Terme de marine. Abri de mât.","next_indent":"Proverbialement. Adieu paniers, se dit quand tout est perdu."}'),
            (11, 'panier.1', 'PANIER', 'calibration', 'calibration_sample', 'sample from NatureLabel/Deterministic (n=1)', '{"sense_num":3,"indent_content":"<nature>Au pluriel.</nature>","role":"NatureLabel","method":"Deterministic","bucket_size":1}'),
            (12, 'panier.1', 'PANIER', 'calibration', 'calibration_sample', 'sample from Proverb/Heuristic (n=1)', '{"sense_num":1,"indent_content":"Proverbialement. Adieu paniers, se dit quand tout est perdu.","role":"Proverb","method":"Heuristic","bucket_size":1,"prev_indent":"Le dessus du panier, le meilleur choix.","next_indent":"Une chose sans règle."}'),
            (13, 'panier.1', 'PANIER', 'calibration', 'calibration_sample', 'sample from Unclassified/Heuristic (n=1)', '{"sense_num":1,"indent_content":"Une chose sans règle.","role":"Unclassified","method":"Heuristic","bucket_size":1,"prev_indent":"Proverbialement. Adieu paniers, se dit quand tout est perdu."}'),
        ],
    ),
    "dict_q20_review_counts": (
        "phase VARCHAR, flag_type VARCHAR, n BIGINT",
        [
            ('calibration', 'calibration_sample', 8),
            ('etymology', 'suspect_language_token', 1),
            ('phase3', 'unclassified', 1),
            ('phase5', 'scope_decision', 2),
            ('structural', 'metonymic_subsense', 1),
        ],
    ),
    "dict_q21_objects": (
        "headword VARCHAR, n_senses BIGINT, n_citations BIGINT, n_locutions BIGINT, n_rubriques BIGINT",
        [
            ('PANIER', 3, 0, 0, 0),
            ('PANIER', 12, 4, 1, 2),
            ('ÉCLAT', 2, 0, 0, 1),
            ('ÉCLAT', 3, 0, 0, 0),
        ],
    ),
    "dict_q24_supplements": (
        "entry_id VARCHAR, headword VARCHAR, pos VARCHAR",
        [
            ('panier.2', 'PANIER', 'v. a.'),
        ],
    ),
    "dict_q24_supplement_senses": (
        "xml_id VARCHAR, content_plain VARCHAR",
        [
            ('eclat_2_s2', 'Rayon.'),
        ],
    ),
    "dict_q25_sense_types": (
        "sense_type VARCHAR, n BIGINT",
        [
            ('cross_reference', 2),
            ('domain', 1),
            ('figurative', 1),
            ('homonymic_entry', 1),
            ('locution', 1),
            ('proverb', 1),
            ('register', 1),
            ('sense', 8),
            ('transition_group', 1),
            ('unclassified', 2),
            ('usage_group', 1),
        ],
    ),
    "dict_q26_roles": (
        "role VARCHAR, n BIGINT",
        [
            ('CrossReference', 2),
            ('DomainLabel', 1),
            ('Figurative', 1),
            ('Locution', 1),
            ('NatureLabel', 1),
            ('Proverb', 1),
            ('RegisterLabel', 1),
            ('Unclassified', 2),
        ],
    ),
    "dict_rq1_by_poet": (
        "headword VARCHAR, text_plain VARCHAR, reference VARCHAR",
        [
            ('PANIER', 'Encore lui', 'ib. 9'),
            ('PANIER', 'Le panier vide', 'ib. 4'),
            ('PANIER', 'Un panier plein', 'Récits, 3'),
        ],
    ),
    "dict_rq3_unclassified": (
        "headword VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 'Grandes jupes.'),
            ('PANIER', 'Une chose sans règle.'),
        ],
    ),
    "dict_starter_entries": (
        "headword VARCHAR, pos VARCHAR",
        [
            ('PANIER', 's. m.'),
            ('PANIER', 'v. a.'),
            ('ÉCLAT', None),
            ('ÉCLAT', None),
        ],
    ),
    "dict_starter_senses": (
        "headword VARCHAR, sense_type VARCHAR, role VARCHAR, content_plain VARCHAR",
        [
            ('PANIER', 'cross_reference', 'CrossReference', 'Voy. CORBEILLE'),
            ('PANIER', 'cross_reference', 'CrossReference', 'voy. CORBEILLE'),
            ('PANIER', 'domain', 'DomainLabel', 'Terme de marine. Abri de mât.'),
            ('PANIER', 'figurative', 'Figurative', 'Fig. Une troupe de gens.'),
            ('PANIER', 'locution', 'Locution', 'Le dessus du panier, le meilleur choix.'),
            ('PANIER', 'proverb', 'Proverb', 'Proverbialement. Adieu paniers, se dit quand tout est perdu.'),
            ('PANIER', 'register', 'RegisterLabel', 'Familièrement, bagages.'),
            ('PANIER', 'sense', None, "Corbeille tressée d'osier."),
            ('PANIER', 'sense', None, 'La mesure.'),
            ('PANIER', 'sense', None, 'Le contenu.'),
            ('PANIER', 'sense', None, 'Voir &amp; mettre.'),
            ('PANIER', 'transition_group', 'NatureLabel', 'Au pluriel.'),
            ('PANIER', 'unclassified', 'Unclassified', 'Grandes jupes.'),
            ('PANIER', 'unclassified', 'Unclassified', 'Une chose sans règle.'),
            ('PANIER', 'usage_group', None, 'Absolument.'),
        ],
    ),
    "rich_entries": (
        "entry_id VARCHAR, headword VARCHAR, homograph_index INTEGER, pronunciation VARCHAR, pos VARCHAR, is_supplement INTEGER, source_letter VARCHAR",
        [
            ('esque', '-ESQUE', None, None, 'suffixe', 0, 'a'),
            ('mot_1_1', 'MOT_1', None, None, None, 0, 'a'),
            ('mot_1_2', 'MOT', None, None, None, 0, 'v'),
            ('mot_2', 'MOT', None, None, None, 0, 'v'),
            ('rendre', 'RENDRE', None, None, 'v. a.', 0, 'w'),
            ('venir', 'VENIR', None, None, None, 0, 'w'),
            ('voile.1', 'VOILE', 1, "voi-l'", 's. m.', 0, 'v'),
            ('voile.2', 'VOILE', 2, "voi-l' ; plusieurs disent autrement, selon les lieux", 's. f. tout neuf', 1, 'v'),
        ],
    ),
    "rich_resumes": (
        "entry_id VARCHAR, resume_text VARCHAR",
        [
            ('voile.1', '<résumé><variante num="1">Résumé du <i>sens</i></variante></résumé>'),
        ],
    ),
    "rich_senses": (
        "sense_id BIGINT, entry_id VARCHAR, parent_sense_id BIGINT, num INTEGER, indent_id VARCHAR, xml_id VARCHAR, sense_type VARCHAR, role VARCHAR, content_plain VARCHAR, content_markup VARCHAR, is_supplement INTEGER, transition_type VARCHAR, transition_form VARCHAR, transition_pos VARCHAR, depth INTEGER",
        [
            (1, 'esque', None, 1, 'esque.1', 'esque_s1', 'sense', None, 'Fin de verbum.', 'Fin de <i lang="la">verbum</i>.', 0, None, None, None, 0),
            (2, 'esque', None, 2, 'esque.2', 'esque_s2', 'sense', None, 'Ajouté.', 'Ajouté.', 1, None, None, None, 0),
            (3, 'esque', None, None, None, 'esque_s3', 'usage_group', None, 'Absolument.', 'Absolument.', 0, 'medium', None, None, 0),
            (4, 'esque', 3, 3, 'esque.3', 'esque_s3.1', 'sense', None, 'Ajouté après.', 'Ajouté après.', 1, None, None, None, 1),
            (5, 'mot_1_1', None, 1, 'mot_1_1.1', 'mot_1_1_s1', 'sense', None, 'Choc de noms.', 'Choc de noms.', 0, None, None, None, 0),
            (6, 'mot_1_1', 5, None, 'mot_1_1.1.1', 'mot_1_1_s1.1', 'annotation', 'VoiceTransition', 'Absolument.', 'Absolument.', 0, None, None, None, 1),
            (7, 'mot_1_1', None, 2, 'mot_1_1.2', 'mot_1_1_s2', 'sense', None, 'Adjectivement, porté.', 'Adjectivement, porté.', 0, None, None, None, 0),
            (8, 'mot_1_1', None, None, None, 'mot_1_1_s3', 'usage_group', None, 'Substantivement.', 'Substantivement.', 0, 'medium', None, None, 0),
            (9, 'mot_1_1', 8, 3, 'mot_1_1.3', 'mot_1_1_s3.1', 'sense', None, 'Porté enfin.', 'Porté enfin.', 0, None, None, None, 1),
            (10, 'voile.1', None, 1, 'voile.1.1', 'voile.1_s1', 'sense', None, "Terme de couture. Pièce d'étoffe, terme de mode, qui cache.", '<semantique type="domaine">Terme de couture.</semantique> Pièce d\'étoffe, <semantique type="domaine">terme de mode</semantique>, qui cache.', 0, None, None, None, 0),
            (11, 'voile.1', 10, None, 'voile.1.1.1', 'voile.1_s1.1', 'figurative', 'Figurative', 'Fig. Ce qui cache.', 'Fig. Ce qui cache.', 0, None, None, None, 1),
            (12, 'voile.1', 11, None, 'voile.1.1.1.1', 'voile.1_s1.1.1', 'unclassified', 'Unclassified', 'Une nuance plus fine.', 'Une nuance plus fine.', 0, None, None, None, 2),
            (13, 'voile.1', 10, None, 'voile.1.1.2', 'voile.1_s1.2', 'figurative', 'Figurative', 'Fig. Apparence trompeuse.', '<semantique type="indicateur">Fig.</semantique> Apparence trompeuse.', 0, None, None, None, 1),
            (14, 'voile.1', 10, None, 'voile.1.1.3', 'voile.1_s1.3', 'domain', 'DomainLabel', "Terme d'anatomie", '<semantique type="domaine">Terme d\'anatomie</semantique>', 0, None, None, None, 1),
            (15, 'voile.1', 10, None, 'voile.1.1.4', 'voile.1_s1.4', 'domain', 'DomainLabel', 'Terme de botanique. Membrane.', '<semantique type="domaine">Terme de botanique.</semantique> Membrane.', 0, None, None, None, 1),
            (16, 'voile.1', 10, None, 'voile.1.1.5', 'voile.1_s1.5', 'register', 'RegisterLabel', 'Familièrement et par dénigrement, personne voilée.', 'Familièrement et par dénigrement, personne voilée.', 0, None, None, None, 1),
            (17, 'voile.1', 10, None, 'voile.1.1.6', 'voile.1_s1.6', 'register', 'RegisterLabel', 'Vieilli.', 'Vieilli.', 0, None, None, None, 1),
            (18, 'voile.1', 10, None, 'voile.1.1.7', 'voile.1_s1.7', 'locution', 'Locution', 'Lever le voile, montrer la vérité. Lever le voile sur tout.', '<exemple>Lever le voile</exemple>, montrer la vérité. <i>Lever le voile</i> <i>sur tout</i>.', 0, None, None, None, 1),
            (19, 'voile.1', 18, None, 'voile.1.1.7.1', 'voile.1_s1.7.1', 'unclassified', 'Unclassified', 'Sous-bloc.', 'Sous-bloc.', 0, None, None, None, 2),
            (20, 'voile.1', 10, None, 'voile.1.1.8', 'voile.1_s1.8', 'locution', 'Locution', 'Prendre le voile, la coutume des nonnes.', '<exemple>Prendre le voile</exemple>, la coutume des nonnes.', 0, None, None, None, 1),
            (21, 'voile.1', 10, None, 'voile.1.1.9', 'voile.1_s1.9', 'sense', 'Locution', 'Voile du palais, la cloison de la bouche.', '<exemple>Voile du palais</exemple>, la cloison de la bouche.', 0, None, None, None, 1),
            (22, 'voile.1', 10, None, 'voile.1.1.10', 'voile.1_s1.10', 'proverb', 'Proverb', "Proverbialement. Petit voile cache grand mal, c'est-à-dire peu suffit.", "Proverbialement. Petit voile cache grand mal, c'est-à-dire peu suffit.", 0, None, None, None, 1),
            (23, 'voile.1', 10, None, 'voile.1.1.11', 'voile.1_s1.11', 'proverb', 'Proverb', 'Prov. Tout voile tombe.', 'Prov. Tout voile tombe.', 0, None, None, None, 1),
            (24, 'voile.1', 10, None, 'voile.1.1.12', 'voile.1_s1.12', 'cross_reference', 'CrossReference', 'Voy. ROBE et ÉTOFFE.', 'Voy. <a ref="robe.2#s1">ROBE</a> et <a ref="Étoffe">ÉTOFFE</a>.', 0, None, None, None, 1),
            (25, 'voile.1', 10, None, 'voile.1.1.13', 'voile.1_s1.13', 'unclassified', 'Unclassified', 'Une chose que nulle règle ne dit.', 'Une chose que nulle règle ne dit.', 0, None, None, None, 1),
            (26, 'voile.1', 10, None, 'voile.1.1.14', 'voile.1_s1.14', 'unclassified', 'Unclassified', 'Locution sans marque', 'Locution sans marque', 0, None, None, None, 1),
            (27, 'voile.1', 10, None, 'voile.1.1.15', 'voile.1_s1.15', 'figurative', 'Figurative', 'Autre chose, dite par verdict.', 'Autre chose, dite par verdict.', 0, None, None, None, 1),
            (28, 'voile.1', 10, None, 'voile.1.1.16', 'voile.1_s1.16', 'unclassified', 'Unclassified', 'Encore une, dont le contrôle ne va pas.', 'Encore une, dont le contrôle ne va pas.', 0, None, None, None, 1),
            (29, 'voile.1', None, 2, 'voile.1.2', 'voile.1_s2', 'sense', None, 'Étoffe légère.', 'Étoffe légère.', 0, None, None, None, 0),
            (30, 'voile.1', 29, None, 'voile.1.2.1', 'voile.1_s2.1', 'transition_group', 'NatureLabel', 'SE VOILER, v. réfl. Se cacher.', 'SE VOILER, <nature>v. réfl.</nature> Se cacher.', 0, None, None, None, 1),
            (31, 'voile.1', 30, None, 'voile.1.2.1.1', 'voile.1_s2.1.1', 'unclassified', 'Unclassified', 'Bloc un.', 'Bloc un.', 0, None, None, None, 2),
            (32, 'voile.1', 30, None, 'voile.1.2.1.2', 'voile.1_s2.1.2', 'unclassified', 'Unclassified', 'Bloc deux.', 'Bloc deux.', 0, None, None, None, 2),
            (33, 'voile.1', 30, None, 'voile.1.2.1.3', 'voile.1_s2.1.3', 'unclassified', 'Unclassified', 'Bloc trois.', 'Bloc trois.', 0, None, None, None, 2),
            (34, 'voile.1', 30, None, 'voile.1.2.1.4', 'voile.1_s2.1.4', 'unclassified', 'Unclassified', 'Bloc quatre.', 'Bloc quatre.', 0, None, None, None, 2),
            (35, 'voile.1', 30, None, 'voile.1.2.1.5', 'voile.1_s2.1.5', 'unclassified', 'Unclassified', 'Bloc cinq.', 'Bloc cinq.', 0, None, None, None, 2),
            (36, 'voile.1', 30, None, 'voile.1.2.1.6', 'voile.1_s2.1.6', 'unclassified', 'Unclassified', 'Bloc six.', 'Bloc six.', 0, None, None, None, 2),
            (37, 'voile.1', 29, None, 'voile.1.2.2', 'voile.1_s2.2', 'annotation', 'NatureLabel', "S'envoiler, v. réfl. Se courber.", "S'envoiler, <nature>v. réfl.</nature> Se courber.", 0, None, None, None, 1),
            (38, 'voile.1', 29, None, 'voile.1.2.3', 'voile.1_s2.3', 'annotation', 'NatureLabel', 'À voile, loc. adv. Par le vent.', 'À voile, <nature>loc. adv.</nature> Par le vent.', 0, None, None, None, 1),
            (39, 'voile.1', 29, None, 'voile.1.2.4', 'voile.1_s2.4', 'annotation', 'NatureLabel', 'Au plur.', '<nature>Au plur.</nature>', 0, None, None, None, 1),
            (40, 'voile.1', 29, None, 'voile.1.2.5', 'voile.1_s2.5', 'annotation', 'VoiceTransition', 'Substantivement, le voilé.', 'Substantivement, le voilé.', 0, None, None, None, 1),
            (41, 'voile.1', None, None, None, 'voile.1_s3', 'usage_group', None, 'Absolument.', 'Absolument.', 0, 'medium', None, None, 0),
            (42, 'voile.1', 41, 3, 'voile.1.3', 'voile.1_s3.1', 'sense', None, 'Premier sens porté.', 'Premier sens porté.', 0, None, None, None, 1),
            (43, 'voile.1', None, None, 'voile.1.1', 'voile.1_s4', 'sense', None, 'Second sens porté.', 'Second sens porté.', 0, None, None, None, 0),
            (44, 'voile.1', 43, None, 'voile.1.1.1', 'voile.1_s4.1', 'unclassified', 'Unclassified', 'Un bloc simple.', 'Un bloc simple.', 0, None, None, None, 1),
            (45, 'voile.1', None, None, None, 'voile.1_s5', 'usage_group', None, 'Neutralement.', 'Neutralement.', 0, 'medium', None, None, 0),
            (46, 'voile.1', 45, 5, 'voile.1.5', 'voile.1_s5.1', 'sense', None, 'Un sens seul.', 'Un sens seul.', 0, None, None, None, 1),
            (47, 'voile.1', 46, None, 'voile.1.5.1', 'voile.1_s5.1.1', 'unclassified', 'Unclassified', "S'ENVOILER, v. réfl. Se plier.", "S'ENVOILER, v. réfl. Se plier.", 0, None, None, None, 2),
            (48, 'voile.1', 45, 6, 'voile.1.6', 'voile.1_s5.2', 'sense', None, 'Sous la forme.', 'Sous la forme.', 0, None, None, None, 1),
            (49, 'voile.2', None, 1, 'voile.2.1', 'voile.2_s1', 'sense', None, 'Toile de vent.', 'Toile de vent.', 0, None, None, None, 0),
            (50, 'mot_1_2', None, None, 'mot_1_2.1', 'mot_1_2_s1', 'sense', None, 'Une chose dite.', 'Une chose dite.', 0, None, None, None, 0),
            (51, 'mot_2', None, None, 'mot_2.1', 'mot_2_s1', 'sense', None, 'Une autre.', 'Une autre.', 0, None, None, None, 0),
            (52, 'rendre', None, 1, 'rendre.1', 'rendre_s1', 'sense', None, 'Remettre.', 'Remettre.', 0, None, None, None, 0),
            (53, 'rendre', 52, None, 'rendre.1.1', 'rendre_s1.1', 'locution', 'Locution', 'Dit sans virgule ni forme', 'Dit sans virgule ni forme', 0, None, None, None, 1),
            (54, 'rendre', 52, None, 'rendre.1.2', 'rendre_s1.2', 'locution', 'Locution', 'Rendre gorge, vomir.', 'Rendre gorge, vomir.', 0, None, None, None, 1),
            (55, 'rendre', None, None, None, 'rendre_s2', 'homonymic_entry', None, 'SE RENDRE, v. réfl. Aller.', 'SE RENDRE, v. réfl. Aller.', 0, 'strong', 'SE RENDRE', 'v. réfl', 0),
            (56, 'rendre', 55, 2, 'rendre.2', 'rendre_s2.1', 'sense', None, 'Céder.', 'Céder.', 0, None, None, None, 1),
            (57, 'rendre', 56, None, 'rendre.2.1', 'rendre_s2.1.1', 'figurative', 'Figurative', 'Fig. Se donner.', 'Fig. Se donner.', 0, None, None, None, 2),
            (58, 'venir', None, 1, 'venir.1', 'venir_s1', 'sense', None, 'Arriver.', 'Arriver.', 0, None, None, None, 0),
            (59, 'venir', None, None, None, 'venir_s2', 'usage_group', None, 'V. n.', 'V. n.', 0, 'medium', None, None, 0),
            (60, 'venir', 59, 2, 'venir.2', 'venir_s2.1', 'sense', None, 'Sens 2.', 'Sens 2.', 0, None, None, None, 1),
            (61, 'venir', 59, 3, 'venir.3', 'venir_s2.2', 'sense', None, 'Sens 3.', 'Sens 3.', 0, None, None, None, 1),
            (62, 'venir', 59, 4, 'venir.4', 'venir_s2.3', 'sense', None, 'Sens 4.', 'Sens 4.', 0, None, None, None, 1),
            (63, 'venir', 59, 5, 'venir.5', 'venir_s2.4', 'sense', None, 'Sens 5.', 'Sens 5.', 0, None, None, None, 1),
            (64, 'venir', 59, 6, 'venir.6', 'venir_s2.5', 'sense', None, 'Sens 6.', 'Sens 6.', 0, None, None, None, 1),
            (65, 'venir', 59, 7, 'venir.7', 'venir_s2.6', 'sense', None, 'Sens 7.', 'Sens 7.', 0, None, None, None, 1),
            (66, 'venir', 59, 8, 'venir.8', 'venir_s2.7', 'sense', None, 'Sens 8.', 'Sens 8.', 0, None, None, None, 1),
            (67, 'venir', 59, 9, 'venir.9', 'venir_s2.8', 'sense', None, 'Sens 9.', 'Sens 9.', 0, None, None, None, 1),
            (68, 'venir', 59, 10, 'venir.10', 'venir_s2.9', 'sense', None, 'Sens 10.', 'Sens 10.', 0, None, None, None, 1),
            (69, 'venir', 59, 11, 'venir.11', 'venir_s2.10', 'sense', None, 'Sens 11.', 'Sens 11.', 0, None, None, None, 1),
            (70, 'venir', 59, 12, 'venir.12', 'venir_s2.11', 'sense', None, 'Sens 12.', 'Sens 12.', 0, None, None, None, 1),
            (71, 'venir', 59, 13, 'venir.13', 'venir_s2.12', 'sense', None, 'Sens 13.', 'Sens 13.', 0, None, None, None, 1),
            (72, 'venir', 59, 14, 'venir.14', 'venir_s2.13', 'sense', None, 'Sens 14.', 'Sens 14.', 0, None, None, None, 1),
            (73, 'venir', 59, 15, 'venir.15', 'venir_s2.14', 'sense', None, 'Sens 15.', 'Sens 15.', 0, None, None, None, 1),
            (74, 'venir', 59, 16, 'venir.16', 'venir_s2.15', 'sense', None, 'Sens 16.', 'Sens 16.', 0, None, None, None, 1),
            (75, 'venir', 59, 17, 'venir.17', 'venir_s2.16', 'sense', None, 'Sens 17.', 'Sens 17.', 0, None, None, None, 1),
            (76, 'venir', 59, 18, 'venir.18', 'venir_s2.17', 'sense', None, 'Sens 18.', 'Sens 18.', 0, None, None, None, 1),
        ],
    ),
    "rich_citations": (
        "citation_id BIGINT, sense_id BIGINT, text_plain VARCHAR, text_markup VARCHAR, author VARCHAR, resolved_author VARCHAR, reference VARCHAR, is_hidden INTEGER",
        [
            (1, 10, 'Un voile blanc', 'Un voile <i>blanc</i>', 'MARIN', 'MARIN', 'Odes, 2', 0),
            (2, 10, 'sans auteur', 'sans auteur', '', '', '', 0),
            (3, 11, 'le voile de la nuit', 'le voile de la nuit', 'ID.', 'MARIN', 'ib.', 1),
            (4, 18, 'il leva le voile', 'il leva le voile', 'ID.', 'MARIN', 'ib. 4', 0),
            (5, 24, 'perdu', 'perdu', 'X', 'X', 'y', 0),
        ],
    ),
    "rich_locutions": (
        "sense_id BIGINT, canonical_form VARCHAR",
        [
            (18, 'Lever le voile'),
            (20, 'Prendre le voile'),
            (54, 'Rendre gorge'),
        ],
    ),
    "rich_forms": (
        "xml_id VARCHAR, role VARCHAR, method VARCHAR, canonical_form VARCHAR, canonical_form_source VARCHAR",
        [
            ('rendre_s1.2', 'Locution', 'LlmAssisted', 'Rendre gorge', 'prose'),
            ('voile.1_s1.10', 'Proverb', 'Heuristic', 'Petit voile cache grand mal', 'prose'),
            ('voile.1_s1.11', 'Proverb', 'Heuristic', 'Tout voile tombe', 'prose'),
            ('voile.1_s1.7', 'Locution', 'Deterministic', 'Lever le voile', 'exemple'),
            ('voile.1_s1.8', 'Locution', 'Deterministic', 'Prendre le voile', 'exemple'),
            ('voile.1_s1.9', 'Locution', 'Deterministic', 'Voile du palais', 'exemple'),
        ],
    ),
    "rich_rubriques": (
        "rubrique_id BIGINT, entry_id VARCHAR, rubrique_type VARCHAR, content_plain VARCHAR, content_markup VARCHAR",
        [
            (1, 'esque', 'Supplement', '', ''),
            (2, 'voile.1', 'Remarque', 'Ce mot fig. voy. ROBE. Autre velum.', 'Ce mot <semantique>fig.</semantique> voy. <a ref="robe">ROBE</a>. Autre <i lang="la">velum</i>.'),
            (3, 'voile.1', 'Historique', 'XIIe s. XVe s. Sans fig. date', 'XIIe s. XVe s. Sans <semantique type="indicateur">fig.</semantique> date'),
            (4, 'voile.1', 'Synonyme', 'VOILE, RIDEAU. Voy. RIDEAU.', 'VOILE, RIDEAU. Voy. <a ref="rideau">RIDEAU</a>.'),
            (5, 'voile.1', 'Proverbes', 'Sous le voile.', 'Sous le voile.'),
            (6, 'voile.1', 'Remarque', 'Genre inconnu.', 'Genre inconnu.'),
            (7, 'voile.1', 'Etymologie', 'Provenç. et esp. vel, voile ; du lat. fictif velum, toile ; orig. douteuse bel ; re πέπλος ; voy. VELOURS gras x', 'Provenç. et esp. <i>vel</i>, voile ; du lat. fictif <i>velum</i>, toile ; orig. douteuse <i>bel</i> ; re πέπλος ; voy. <a ref="velours.2">VELOURS</a> <b>gras</b> <i>x</i>'),
        ],
    ),
    "rich_flags": (
        "review_id BIGINT, entry_id VARCHAR, phase VARCHAR, flag_type VARCHAR, reason VARCHAR, context VARCHAR",
        [
            (1, 'voile.1', 'phase3', 'unclassified', 'no rule matched', '{"sense_num":1,"indent_content":"Une chose que nulle règle ne dit.","method":"Heuristic","prev_indent":"Voy. ROBE et ÉTOFFE.","next_indent":"Locution sans marque"}'),
            (2, 'voile.1', 'phase3', 'unclassified', 'no rule matched', '{"sense_num":1,"indent_content":"Locution sans marque","method":"Heuristic","prev_indent":"Une chose que nulle règle ne dit.","next_indent":"Autre chose, dite par verdict."}'),
            (3, 'voile.1', 'phase3', 'unclassified', 'no rule matched', '{"sense_num":1,"indent_content":"Encore une, dont le contrôle ne va pas.","method":"Heuristic","prev_indent":"Autre chose, dite par verdict."}'),
            (4, 'voile.1', 'phase3', 'unclassified', 'no rule matched', '{"sense_num":null,"indent_content":"Un bloc simple.","method":"Heuristic"}'),
            (5, 'voile.1', 'phase3', 'unclassified', 'no rule matched', '{"sense_num":5,"indent_content":"S\'ENVOILER, v. réfl. Se plier.","method":"Heuristic"}'),
            (6, 'rendre', 'phase4', 'skipped_locution', 'no canonical form extracted', '{"sense_num":1,"indent_content":"Dit sans virgule ni forme"}'),
            (7, 'voile.1', 'phase3', 'likely_locution', 'starts with Loc./Locution but classified as Unclassified', '{"sense_num":1,"indent_content":"Locution sans marque","current_role":"Unclassified"}'),
            (8, 'esque', 'phase5', 'scope_decision', 'medium scope, 1 senses', '{"transition_content":"Absolument.","scope_type":"medium","transition_form":"","transition_pos":"","num_scoped":1,"first_scoped":"Ajouté après.","last_scoped":"Ajouté après."}'),
            (9, 'mot_1_1', 'phase5', 'scope_decision', 'medium scope, 1 senses', '{"transition_content":"Substantivement.","scope_type":"medium","transition_form":"","transition_pos":"","num_scoped":1,"first_scoped":"Porté enfin.","last_scoped":"Porté enfin."}'),
            (10, 'voile.1', 'phase5', 'large_intra_scope', 'NatureLabel scoped 6 children', '{"sense_num":2,"indent_content":"SE VOILER, v. réfl. Se cacher.","num_children":6}'),
            (11, 'voile.1', 'phase5', 'scope_decision', 'medium scope, 1 senses', '{"transition_content":"Absolument.","scope_type":"medium","transition_form":"","transition_pos":"","num_scoped":1,"first_scoped":"Premier sens porté.","last_scoped":"Premier sens porté."}'),
            (12, 'voile.1', 'phase5', 'scope_decision', 'medium scope, 2 senses', '{"transition_content":"Neutralement.","scope_type":"medium","transition_form":"","transition_pos":"","num_scoped":2,"first_scoped":"Un sens seul.","last_scoped":"Sous la forme."}'),
            (13, 'rendre', 'phase5', 'scope_decision', 'strong scope, 1 senses', '{"transition_content":"SE RENDRE, v. réfl. Aller.","scope_type":"strong","transition_form":"SE RENDRE","transition_pos":"v. réfl","num_scoped":1,"first_scoped":"Céder.","last_scoped":"Céder."}'),
            (14, 'venir', 'phase5', 'large_scope', 'medium scope, 17 senses', '{"transition_content":"V. n.","scope_type":"medium","transition_form":"","transition_pos":"","num_scoped":17,"first_scoped":"Sens 2.","last_scoped":"Sens 18."}'),
            (15, 'voile.1', 'structural', 'metonymic_subsense', 'locution gloss opens with a definite article', '{"canonical_form":"Prendre le voile","gloss":"la coutume des nonnes."}'),
            (16, 'voile.1', 'structural', 'metonymic_subsense', 'locution gloss opens with a definite article', '{"canonical_form":"Voile du palais","gloss":"la cloison de la bouche."}'),
            (17, 'venir', 'structural', 'sense_level_valency', 'valency transition scoped without a printed form', '{"transition_content":"V. n.","num_scoped":17}'),
            (18, 'voile.1', 'structural', 'synonyme_citations', '1 citations emitted as siblings after the synonymy xr', '{"num_citations":1}'),
            (19, 'voile.1', 'structural', 'intra_sense_form', 'printed form on an intra-sense transition (reflexive_form)', '{"form":"S\'envoiler","label":"v. réfl."}'),
            (20, 'voile.1', 'structural', 'intra_sense_form', 'printed form on an intra-sense transition (locution_form)', '{"form":"À voile","label":"loc. adv."}'),
            (21, 'voile.1', 'etymology', 'cognate_defaulted', 'etymon-vs-cognate not disambiguated by surrounding prose', '{"forms":"bel"}'),
            (22, 'voile.1', 'etymology', 'suspect_language_token', 'token in language-abbreviation position missing from language table', '{"token":"re","anchor":"re"}'),
            (23, 'voile.1', 'etymology', 'etym_fallback', 'content carries markup outside the segmentable inventory; emitted as pre-W4 prose', '{"content":"<b>gras</b> <i>x</i>"}'),
        ],
    ),
    "rich_samples": (
        "reason VARCHAR, n BIGINT",
        [
            ('sample from CrossReference/Deterministic (n=1)', 1),
            ('sample from DomainLabel/Deterministic (n=2)', 2),
            ('sample from Figurative/Deterministic (n=1)', 1),
            ('sample from Figurative/Heuristic (n=2)', 2),
            ('sample from Figurative/LlmAssisted (n=1)', 1),
            ('sample from Locution/Deterministic (n=3)', 3),
            ('sample from Locution/LlmAssisted (n=2)', 2),
            ('sample from NatureLabel/Deterministic (n=4)', 4),
            ('sample from Proverb/Heuristic (n=2)', 2),
            ('sample from RegisterLabel/Heuristic (n=2)', 2),
            ('sample from Unclassified/Heuristic (n=5)', 5),
            ('sample from VoiceTransition/Heuristic (n=2)', 2),
        ],
    ),
    "rich_metrics": (
        "metric VARCHAR, value DOUBLE",
        [
            ('ambiguous_scopes', 1.0),
            ('classified', 41.0),
            ('cue_hit_rate', 75.0),
            ('cues_resolved', 3.0),
            ('cues_suspect', 1.0),
            ('flag calibration_sample', 27.0),
            ('flag cognate_defaulted', 1.0),
            ('flag etym_fallback', 1.0),
            ('flag intra_sense_form', 2.0),
            ('flag large_intra_scope', 1.0),
            ('flag large_scope', 1.0),
            ('flag likely_locution', 1.0),
            ('flag metonymic_subsense', 2.0),
            ('flag scope_decision', 5.0),
            ('flag sense_level_valency', 1.0),
            ('flag skipped_locution', 1.0),
            ('flag suspect_language_token', 1.0),
            ('flag synonyme_citations', 1.0),
            ('flag unclassified', 5.0),
            ('indents', 41.0),
            ('intra_grouped', 6.0),
            ('medium_scoped', 22.0),
            ('percent_classified', 100.0),
            ('role CrossReference', 1.0),
            ('role DomainLabel', 2.0),
            ('role Figurative', 4.0),
            ('role Locution', 5.0),
            ('role NatureLabel', 4.0),
            ('role Proverb', 2.0),
            ('role RegisterLabel', 2.0),
            ('role Unclassified', 13.0),
            ('role VoiceTransition', 8.0),
            ('strong_scoped', 1.0),
            ('unknown_rubriques', 1.0),
            ('zero_scope', 1.0),
        ],
    ),
    "rich_mismatches": (
        "source_file VARCHAR, source_line INTEGER, check VARCHAR, actual VARCHAR",
        [
            ('v.xml', 25, 'Pas ce texte', 'Encore une, dont le contrôle n'),
        ],
    ),
    "rich_tei": (
        "entry_id VARCHAR, i INTEGER, line VARCHAR",
        [
            ('esque', 0, '  <entry xml:id="esque" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('esque', 1, '    <form type="lemma">'),
            ('esque', 2, '      <orth norm="-esque">-ESQUE</orth>'),
            ('esque', 3, '    </form>'),
            ('esque', 4, '    <gramGrp><gram type="pos" norm="suffix">suffixe</gram></gramGrp>'),
            ('esque', 5, '    <sense xml:id="esque_s1" n="1">'),
            ('esque', 6, '      <def>Fin de <hi rend="italic" xml:lang="la">verbum</hi>.</def>'),
            ('esque', 7, '    </sense>'),
            ('esque', 8, '    <sense xml:id="esque_s2" n="2" source="supplement">'),
            ('esque', 9, '      <def>Ajouté.</def>'),
            ('esque', 10, '    </sense>'),
            ('esque', 11, '    <sense xml:id="esque_s3">'),
            ('esque', 12, '      <gramGrp><gram type="construction" norm="absolute">absolument</gram></gramGrp>'),
            ('esque', 13, '      <sense xml:id="esque_s3.1" n="3" source="supplement">'),
            ('esque', 14, '        <def>Ajouté après.</def>'),
            ('esque', 15, '      </sense>'),
            ('esque', 16, '    </sense>'),
            ('esque', 17, '    <note type="supplément">'),
            ('esque', 18, '    </note>'),
            ('esque', 19, '  </entry>'),
            ('mot_1_1', 0, '  <entry xml:id="mot_1_1" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('mot_1_1', 1, '    <form type="lemma">'),
            ('mot_1_1', 2, '      <orth norm="mot_1">MOT_1</orth>'),
            ('mot_1_1', 3, '    </form>'),
            ('mot_1_1', 4, '    <sense xml:id="mot_1_1_s1" n="1">'),
            ('mot_1_1', 5, '      <def>Choc de noms.</def>'),
            ('mot_1_1', 6, '      <gramGrp><gram type="construction" norm="absolute">absolument</gram></gramGrp>'),
            ('mot_1_1', 7, '    </sense>'),
            ('mot_1_1', 8, '    <sense xml:id="mot_1_1_s2" n="2">'),
            ('mot_1_1', 9, '      <def>Adjectivement, porté.</def>'),
            ('mot_1_1', 10, '    </sense>'),
            ('mot_1_1', 11, '    <sense xml:id="mot_1_1_s3">'),
            ('mot_1_1', 12, '      <gramGrp><gram type="construction" norm="substantival">substantivement</gram></gramGrp>'),
            ('mot_1_1', 13, '      <sense xml:id="mot_1_1_s3.1" n="3">'),
            ('mot_1_1', 14, '        <def>Porté enfin.</def>'),
            ('mot_1_1', 15, '      </sense>'),
            ('mot_1_1', 16, '    </sense>'),
            ('mot_1_1', 17, '  </entry>'),
            ('mot_1_2', 0, '  <entry xml:id="mot_1_2" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('mot_1_2', 1, '    <form type="lemma">'),
            ('mot_1_2', 2, '      <orth norm="mot">MOT</orth>'),
            ('mot_1_2', 3, '    </form>'),
            ('mot_1_2', 4, '    <sense xml:id="mot_1_2_s1">'),
            ('mot_1_2', 5, '      <def>Une chose dite.</def>'),
            ('mot_1_2', 6, '    </sense>'),
            ('mot_1_2', 7, '  </entry>'),
            ('mot_2', 0, '  <entry xml:id="mot_2" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('mot_2', 1, '    <form type="lemma">'),
            ('mot_2', 2, '      <orth norm="mot">MOT</orth>'),
            ('mot_2', 3, '    </form>'),
            ('mot_2', 4, '    <sense xml:id="mot_2_s1">'),
            ('mot_2', 5, '      <def>Une autre.</def>'),
            ('mot_2', 6, '    </sense>'),
            ('mot_2', 7, '  </entry>'),
            ('rendre', 0, '  <entry xml:id="rendre" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('rendre', 1, '    <form type="lemma">'),
            ('rendre', 2, '      <orth norm="rendre">RENDRE</orth>'),
            ('rendre', 3, '    </form>'),
            ('rendre', 4, '    <gramGrp><gram type="pos" norm="verb">v.</gram><gram type="valency" norm="active">a.</gram></gramGrp>'),
            ('rendre', 5, '    <sense xml:id="rendre_s1" n="1">'),
            ('rendre', 6, '      <def>Remettre.</def>'),
            ('rendre', 7, '      <sense xml:id="rendre_s1.1">'),
            ('rendre', 8, '        <def>Dit sans virgule ni forme</def>'),
            ('rendre', 9, '      </sense>'),
            ('rendre', 10, '      <entry xml:id="rendre_s1.2.rendre_gorge" xml:lang="fr-x-lit19c" type="relatedEntry">'),
            ('rendre', 11, '        <form type="lemma"><orth value="Rendre gorge"/></form>'),
            ('rendre', 12, '        <sense xml:id="rendre_s1.2.rendre_gorge.1">'),
            ('rendre', 13, '          <def>vomir.</def>'),
            ('rendre', 14, '        </sense>'),
            ('rendre', 15, '      </entry>'),
            ('rendre', 16, '    </sense>'),
            ('rendre', 17, '    <entry xml:id="rendre_s2" xml:lang="fr-x-lit19c" type="homonymicEntry">'),
            ('rendre', 18, '      <form type="lemma"><orth>SE RENDRE</orth></form>'),
            ('rendre', 19, '      <gramGrp><gram type="pos" norm="verb">v.</gram><gram type="valency" norm="reflexive">réfl</gram></gramGrp>'),
            ('rendre', 20, '      <sense xml:id="rendre_s2.1" n="2">'),
            ('rendre', 21, '        <def>Céder.</def>'),
            ('rendre', 22, '        <sense xml:id="rendre_s2.1.1" ana="figurative">'),
            ('rendre', 23, '          <usg type="meaningType" norm="figurative">fig.</usg>'),
            ('rendre', 24, '          <def>Se donner.</def>'),
            ('rendre', 25, '        </sense>'),
            ('rendre', 26, '      </sense>'),
            ('rendre', 27, '    </entry>'),
            ('rendre', 28, '  </entry>'),
            ('venir', 0, '  <entry xml:id="venir" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('venir', 1, '    <form type="lemma">'),
            ('venir', 2, '      <orth norm="venir">VENIR</orth>'),
            ('venir', 3, '    </form>'),
            ('venir', 4, '    <sense xml:id="venir_s1" n="1">'),
            ('venir', 5, '      <def>Arriver.</def>'),
            ('venir', 6, '    </sense>'),
            ('venir', 7, '    <sense xml:id="venir_s2">'),
            ('venir', 8, '      <gramGrp><gram type="pos" norm="verb">v.</gram><gram type="valency" norm="intransitive">n.</gram></gramGrp>'),
            ('venir', 9, '      <sense xml:id="venir_s2.1" n="2">'),
            ('venir', 10, '        <def>Sens 2.</def>'),
            ('venir', 11, '      </sense>'),
            ('venir', 12, '      <sense xml:id="venir_s2.2" n="3">'),
            ('venir', 13, '        <def>Sens 3.</def>'),
            ('venir', 14, '      </sense>'),
            ('venir', 15, '      <sense xml:id="venir_s2.3" n="4">'),
            ('venir', 16, '        <def>Sens 4.</def>'),
            ('venir', 17, '      </sense>'),
            ('venir', 18, '      <sense xml:id="venir_s2.4" n="5">'),
            ('venir', 19, '        <def>Sens 5.</def>'),
            ('venir', 20, '      </sense>'),
            ('venir', 21, '      <sense xml:id="venir_s2.5" n="6">'),
            ('venir', 22, '        <def>Sens 6.</def>'),
            ('venir', 23, '      </sense>'),
            ('venir', 24, '      <sense xml:id="venir_s2.6" n="7">'),
            ('venir', 25, '        <def>Sens 7.</def>'),
            ('venir', 26, '      </sense>'),
            ('venir', 27, '      <sense xml:id="venir_s2.7" n="8">'),
            ('venir', 28, '        <def>Sens 8.</def>'),
            ('venir', 29, '      </sense>'),
            ('venir', 30, '      <sense xml:id="venir_s2.8" n="9">'),
            ('venir', 31, '        <def>Sens 9.</def>'),
            ('venir', 32, '      </sense>'),
            ('venir', 33, '      <sense xml:id="venir_s2.9" n="10">'),
            ('venir', 34, '        <def>Sens 10.</def>'),
            ('venir', 35, '      </sense>'),
            ('venir', 36, '      <sense xml:id="venir_s2.10" n="11">'),
            ('venir', 37, '        <def>Sens 11.</def>'),
            ('venir', 38, '      </sense>'),
            ('venir', 39, '      <sense xml:id="venir_s2.11" n="12">'),
            ('venir', 40, '        <def>Sens 12.</def>'),
            ('venir', 41, '      </sense>'),
            ('venir', 42, '      <sense xml:id="venir_s2.12" n="13">'),
            ('venir', 43, '        <def>Sens 13.</def>'),
            ('venir', 44, '      </sense>'),
            ('venir', 45, '      <sense xml:id="venir_s2.13" n="14">'),
            ('venir', 46, '        <def>Sens 14.</def>'),
            ('venir', 47, '      </sense>'),
            ('venir', 48, '      <sense xml:id="venir_s2.14" n="15">'),
            ('venir', 49, '        <def>Sens 15.</def>'),
            ('venir', 50, '      </sense>'),
            ('venir', 51, '      <sense xml:id="venir_s2.15" n="16">'),
            ('venir', 52, '        <def>Sens 16.</def>'),
            ('venir', 53, '      </sense>'),
            ('venir', 54, '      <sense xml:id="venir_s2.16" n="17">'),
            ('venir', 55, '        <def>Sens 17.</def>'),
            ('venir', 56, '      </sense>'),
            ('venir', 57, '      <sense xml:id="venir_s2.17" n="18">'),
            ('venir', 58, '        <def>Sens 18.</def>'),
            ('venir', 59, '      </sense>'),
            ('venir', 60, '    </sense>'),
            ('venir', 61, '  </entry>'),
            ('voile.1', 0, '  <entry xml:id="voile.1" xml:lang="fr-x-lit19c" type="mainEntry">'),
            ('voile.1', 1, '    <form type="lemma">'),
            ('voile.1', 2, '      <orth norm="voile">VOILE</orth>'),
            ('voile.1', 3, "      <pron>voi-l'</pron>"),
            ('voile.1', 4, '    </form>'),
            ('voile.1', 5, '    <gramGrp><gram type="pos" norm="noun">s.</gram><gram type="gender" norm="masculine">m.</gram></gramGrp>'),
            ('voile.1', 6, '    <sense xml:id="voile.1_s1" n="1">'),
            ('voile.1', 7, '      <usg type="domain">terme de couture.</usg>'),
            ('voile.1', 8, "      <def>Pièce d'étoffe, qui cache.</def>"),
            ('voile.1', 9, '      <usg type="domain">terme de mode</usg>'),
            ('voile.1', 10, '      <cit type="example">'),
            ('voile.1', 11, '        <quote>Un voile <hi rend="italic">blanc</hi></quote>'),
            ('voile.1', 12, '        <bibl>'),
            ('voile.1', 13, '          <author>MARIN</author>'),
            ('voile.1', 14, '          <biblScope>Odes, 2</biblScope>'),
            ('voile.1', 15, '        </bibl>'),
            ('voile.1', 16, '      </cit>'),
            ('voile.1', 17, '      <cit type="example">'),
            ('voile.1', 18, '        <quote>sans auteur</quote>'),
            ('voile.1', 19, '      </cit>'),
            ('voile.1', 20, '      <sense xml:id="voile.1_s1.1" ana="figurative">'),
            ('voile.1', 21, '        <usg type="meaningType" norm="figurative">fig.</usg>'),
            ('voile.1', 22, '        <def>Ce qui cache.</def>'),
            ('voile.1', 23, '        <cit type="example" ana="hidden">'),
            ('voile.1', 24, '          <quote>le voile de la nuit</quote>'),
            ('voile.1', 25, '          <bibl>'),
            ('voile.1', 26, '            <author>MARIN</author>'),
            ('voile.1', 27, '            <biblScope>ib.</biblScope>'),
            ('voile.1', 28, '          </bibl>'),
            ('voile.1', 29, '        </cit>'),
            ('voile.1', 30, '        <sense xml:id="voile.1_s1.1.1" ana="unclassified">'),
            ('voile.1', 31, '          <def>Une nuance plus fine.</def>'),
            ('voile.1', 32, '        </sense>'),
            ('voile.1', 33, '      </sense>'),
            ('voile.1', 34, '      <sense xml:id="voile.1_s1.2" ana="figurative">'),
            ('voile.1', 35, '        <usg type="meaningType" norm="figurative">fig.</usg>'),
            ('voile.1', 36, '        <def>Apparence trompeuse.</def>'),
            ('voile.1', 37, '      </sense>'),
            ('voile.1', 38, '      <sense xml:id="voile.1_s1.3">'),
            ('voile.1', 39, '        <usg type="domain">terme d\'anatomie</usg>'),
            ('voile.1', 40, '      </sense>'),
            ('voile.1', 41, '      <sense xml:id="voile.1_s1.4">'),
            ('voile.1', 42, '        <usg type="domain">terme de botanique.</usg>'),
            ('voile.1', 43, '        <def>Membrane.</def>'),
            ('voile.1', 44, '      </sense>'),
            ('voile.1', 45, '      <sense xml:id="voile.1_s1.5">'),
            ('voile.1', 46, '        <usg type="socioCultural" norm="familiar">familièrement</usg>'),
            ('voile.1', 47, '        <usg type="attitude" norm="derogatory">par dénigrement</usg>'),
            ('voile.1', 48, '        <def>personne voilée.</def>'),
            ('voile.1', 49, '      </sense>'),
            ('voile.1', 50, '      <sense xml:id="voile.1_s1.6">'),
            ('voile.1', 51, '        <usg type="temporal" norm="archaic">vieilli.</usg>'),
            ('voile.1', 52, '      </sense>'),
            ('voile.1', 53, '      <entry xml:id="voile.1_s1.7.lever_le_voile" xml:lang="fr-x-lit19c" type="relatedEntry">'),
            ('voile.1', 54, '        <form type="lemma"><orth>Lever le voile</orth></form>'),
            ('voile.1', 55, '        <sense xml:id="voile.1_s1.7.lever_le_voile.1">'),
            ('voile.1', 56, '          <def>montrer la vérité.</def>'),
            ('voile.1', 57, '          <cit type="example">'),
            ('voile.1', 58, '            <quote>sur tout</quote>'),
            ('voile.1', 59, '          </cit>'),
            ('voile.1', 60, '          <cit type="example">'),
            ('voile.1', 61, '            <quote>il leva le voile</quote>'),
            ('voile.1', 62, '            <bibl>'),
            ('voile.1', 63, '              <author>MARIN</author>'),
            ('voile.1', 64, '              <biblScope>ib. 4</biblScope>'),
            ('voile.1', 65, '            </bibl>'),
            ('voile.1', 66, '          </cit>'),
            ('voile.1', 67, '          <sense xml:id="voile.1_s1.7.lever_le_voile.1.1" ana="unclassified">'),
            ('voile.1', 68, '            <def>Sous-bloc.</def>'),
            ('voile.1', 69, '          </sense>'),
            ('voile.1', 70, '        </sense>'),
            ('voile.1', 71, '      </entry>'),
            ('voile.1', 72, '      <entry xml:id="voile.1_s1.8.prendre_le_voile" xml:lang="fr-x-lit19c" type="relatedEntry">'),
            ('voile.1', 73, '        <form type="lemma"><orth>Prendre le voile</orth></form>'),
            ('voile.1', 74, '        <sense xml:id="voile.1_s1.8.prendre_le_voile.1">'),
            ('voile.1', 75, '          <def>la coutume des nonnes.</def>'),
            ('voile.1', 76, '        </sense>'),
            ('voile.1', 77, '      </entry>'),
            ('voile.1', 78, '      <sense xml:id="voile.1_s1.9">'),
            ('voile.1', 79, '        <def><hi rend="italic">Voile du palais</hi>, la cloison de la bouche.</def>'),
            ('voile.1', 80, '      </sense>'),
            ('voile.1', 81, '      <entry xml:id="voile.1_s1.10.petit_voile_cache_grand_mal" xml:lang="fr-x-lit19c" type="relatedEntry">'),
            ('voile.1', 82, '        <form type="lemma"><orth value="Petit voile cache grand mal"/></form>'),
            ('voile.1', 83, '        <sense xml:id="voile.1_s1.10.petit_voile_cache_grand_mal.1">'),
            ('voile.1', 84, '          <usg type="meaningType" norm="proverbial">Proverbialement.</usg>'),
            ('voile.1', 85, "          <def>c'est-à-dire peu suffit.</def>"),
            ('voile.1', 86, '        </sense>'),
            ('voile.1', 87, '      </entry>'),
            ('voile.1', 88, '      <entry xml:id="voile.1_s1.11.tout_voile_tombe" xml:lang="fr-x-lit19c" type="relatedEntry">'),
            ('voile.1', 89, '        <form type="lemma"><orth value="Tout voile tombe"/></form>'),
            ('voile.1', 90, '        <sense xml:id="voile.1_s1.11.tout_voile_tombe.1">'),
            ('voile.1', 91, '          <usg type="meaningType" norm="proverbial">Prov.</usg>'),
            ('voile.1', 92, '          <def>Tout voile tombe.</def>'),
            ('voile.1', 93, '        </sense>'),
            ('voile.1', 94, '      </entry>'),
            ('voile.1', 95, '      <xr type="related" xml:id="voile.1_s1.12"><lbl>Voy.</lbl><ref type="entry" target="#robe.2">ROBE</ref><seg> et </seg><ref type="entry" target="#etoffe">ÉTOFFE</ref><seg>.</seg></xr>'),
            ('voile.1', 96, '      <sense xml:id="voile.1_s1.13" ana="unclassified">'),
            ('voile.1', 97, '        <def>Une chose que nulle règle ne dit.</def>'),
            ('voile.1', 98, '      </sense>'),
            ('voile.1', 99, '      <sense xml:id="voile.1_s1.14" ana="unclassified">'),
            ('voile.1', 100, '        <def>Locution sans marque</def>'),
            ('voile.1', 101, '      </sense>'),
            ('voile.1', 102, '      <sense xml:id="voile.1_s1.15" ana="figurative">'),
            ('voile.1', 103, '        <usg type="hint">autre chose, dite par verdict.</usg>'),
            ('voile.1', 104, '      </sense>'),
            ('voile.1', 105, '      <sense xml:id="voile.1_s1.16" ana="unclassified">'),
            ('voile.1', 106, '        <def>Encore une, dont le contrôle ne va pas.</def>'),
            ('voile.1', 107, '      </sense>'),
            ('voile.1', 108, '    </sense>'),
            ('voile.1', 109, '    <sense xml:id="voile.1_s2" n="2">'),
            ('voile.1', 110, '      <def>Étoffe légère.</def>'),
            ('voile.1', 111, '      <sense xml:id="voile.1_s2.1">'),
            ('voile.1', 112, '        <gramGrp><gram type="pos" norm="verb">v.</gram><gram type="valency" norm="reflexive">réfl.</gram></gramGrp>'),
            ('voile.1', 113, '        <def>Se cacher.</def>'),
            ('voile.1', 114, '        <sense xml:id="voile.1_s2.1.1" ana="unclassified">'),
            ('voile.1', 115, '          <def>Bloc un.</def>'),
            ('voile.1', 116, '        </sense>'),
            ('voile.1', 117, '        <sense xml:id="voile.1_s2.1.2" ana="unclassified">'),
            ('voile.1', 118, '          <def>Bloc deux.</def>'),
            ('voile.1', 119, '        </sense>'),
            ('voile.1', 120, '        <sense xml:id="voile.1_s2.1.3" ana="unclassified">'),
            ('voile.1', 121, '          <def>Bloc trois.</def>'),
            ('voile.1', 122, '        </sense>'),
            ('voile.1', 123, '        <sense xml:id="voile.1_s2.1.4" ana="unclassified">'),
            ('voile.1', 124, '          <def>Bloc quatre.</def>'),
            ('voile.1', 125, '        </sense>'),
            ('voile.1', 126, '        <sense xml:id="voile.1_s2.1.5" ana="unclassified">'),
            ('voile.1', 127, '          <def>Bloc cinq.</def>'),
            ('voile.1', 128, '        </sense>'),
            ('voile.1', 129, '        <sense xml:id="voile.1_s2.1.6" ana="unclassified">'),
            ('voile.1', 130, '          <def>Bloc six.</def>'),
            ('voile.1', 131, '        </sense>'),
            ('voile.1', 132, '      </sense>'),
            ('voile.1', 133, '      <sense xml:id="voile.1_s2.2">'),
            ('voile.1', 134, '        <form type="lemma"><orth>S\'envoiler</orth></form>'),
            ('voile.1', 135, '        <gramGrp><gram type="pos" norm="verb">v.</gram><gram type="valency" norm="reflexive">réfl.</gram></gramGrp>'),
            ('voile.1', 136, '        <def>Se courber.</def>'),
            ('voile.1', 137, '      </sense>'),
            ('voile.1', 138, '      <sense xml:id="voile.1_s2.3">'),
            ('voile.1', 139, '        <form type="lemma"><orth>À voile</orth></form>'),
            ('voile.1', 140, '        <gramGrp><gram type="pos" norm="phrase">loc.</gram><gram type="pos" norm="adverb">adv.</gram></gramGrp>'),
            ('voile.1', 141, '        <def>Par le vent.</def>'),
            ('voile.1', 142, '      </sense>'),
            ('voile.1', 143, '      <gramGrp><gram type="number" norm="plural">au plur</gram></gramGrp>'),
            ('voile.1', 144, '      <sense xml:id="voile.1_s2.5">'),
            ('voile.1', 145, '        <gramGrp><gram type="construction" norm="substantival">substantivement</gram></gramGrp>'),
            ('voile.1', 146, '        <def>le voilé.</def>'),
            ('voile.1', 147, '      </sense>'),
            ('voile.1', 148, '    </sense>'),
            ('voile.1', 149, '    <sense xml:id="voile.1_s3">'),
            ('voile.1', 150, '      <gramGrp><gram type="construction" norm="absolute">absolument</gram></gramGrp>'),
            ('voile.1', 151, '      <sense xml:id="voile.1_s3.1" n="3">'),
            ('voile.1', 152, '        <def>Premier sens porté.</def>'),
            ('voile.1', 153, '      </sense>'),
            ('voile.1', 154, '    </sense>'),
            ('voile.1', 155, '    <sense xml:id="voile.1_s4">'),
            ('voile.1', 156, '      <def>Second sens porté.</def>'),
            ('voile.1', 157, '      <sense xml:id="voile.1_s4.1" ana="unclassified">'),
            ('voile.1', 158, '        <def>Un bloc simple.</def>'),
            ('voile.1', 159, '      </sense>'),
            ('voile.1', 160, '    </sense>'),
            ('voile.1', 161, '    <sense xml:id="voile.1_s5">'),
            ('voile.1', 162, '      <gramGrp><gram type="construction" norm="intransitive">neutralement</gram></gramGrp>'),
            ('voile.1', 163, '      <sense xml:id="voile.1_s5.1" n="5">'),
            ('voile.1', 164, '        <def>Un sens seul.</def>'),
            ('voile.1', 165, '        <sense xml:id="voile.1_s5.1.1" ana="unclassified">'),
            ('voile.1', 166, "          <def>S'ENVOILER, v. réfl. Se plier.</def>"),
            ('voile.1', 167, '        </sense>'),
            ('voile.1', 168, '        <note type="remarque">'),
            ('voile.1', 169, '          Note du sens, absolument.'),
            ('voile.1', 170, '        </note>'),
            ('voile.1', 171, '      </sense>'),
            ('voile.1', 172, '      <sense xml:id="voile.1_s5.2" n="6">'),
            ('voile.1', 173, '        <def>Sous la forme.</def>'),
            ('voile.1', 174, '      </sense>'),
            ('voile.1', 175, '    </sense>'),
            ('voile.1', 176, '    <note type="remarque">'),
            ('voile.1', 177, '      Ce mot fig. <xr type="related"><lbl>voy.</lbl><ref type="entry" target="#robe">ROBE</ref></xr>.'),
            ('voile.1', 178, '      Autre <hi rend="italic" xml:lang="la">velum</hi>.'),
            ('voile.1', 179, '    </note>'),
            ('voile.1', 180, '    <cit type="example">'),
            ('voile.1', 181, '      <quote>remarque citée</quote>'),
            ('voile.1', 182, '      <bibl>'),
            ('voile.1', 183, '        <author>R</author>'),
            ('voile.1', 184, '        <biblScope>1</biblScope>'),
            ('voile.1', 185, '      </bibl>'),
            ('voile.1', 186, '    </cit>'),
            ('voile.1', 187, '    <etym>'),
            ('voile.1', 188, '      <cit type="cognate" xml:lang="pro">'),
            ('voile.1', 189, '        <lang expand="provençal" norm="pro">Provenç.</lang>'),
            ('voile.1', 190, '        <form><orth>vel</orth></form>'),
            ('voile.1', 191, '      </cit>'),
            ('voile.1', 192, '      <lbl>et</lbl>'),
            ('voile.1', 193, '      <cit type="cognate" xml:lang="es">'),
            ('voile.1', 194, '        <lang expand="espagnol" norm="es">esp.</lang>'),
            ('voile.1', 195, '        <form><orth>vel</orth></form>'),
            ('voile.1', 196, '        <gloss>voile</gloss>'),
            ('voile.1', 197, '      </cit>'),
            ('voile.1', 198, '      <lbl>du</lbl>'),
            ('voile.1', 199, '      <cit type="etymon" xml:lang="la">'),
            ('voile.1', 200, '        <lang expand="latin" norm="la">lat.</lang>'),
            ('voile.1', 201, '        <usg type="hint">fictif</usg>'),
            ('voile.1', 202, '        <form><orth>velum</orth></form>'),
            ('voile.1', 203, '        <gloss>toile</gloss>'),
            ('voile.1', 204, '      </cit>'),
            ('voile.1', 205, '      orig. douteuse'),
            ('voile.1', 206, '      <cit type="cognate">'),
            ('voile.1', 207, '        <form><orth>bel</orth></form>'),
            ('voile.1', 208, '      </cit>'),
            ('voile.1', 209, '      <lbl ana="suspect">re</lbl>'),
            ('voile.1', 210, '      <cit type="cognate" xml:lang="grc">'),
            ('voile.1', 211, '        <form><orth>πέπλος</orth></form>'),
            ('voile.1', 212, '      </cit>'),
            ('voile.1', 213, '      <xr type="related"><lbl>voy.</lbl><ref type="entry" target="#velours.2">VELOURS</ref></xr>'),
            ('voile.1', 214, '      <b>gras</b> <hi rend="italic">x</hi>'),
            ('voile.1', 215, '      <lbl>XIIe s.</lbl>'),
            ('voile.1', 216, '      <cit type="example" ana="attestation">'),
            ('voile.1', 217, '        <quote>li voiles</quote>'),
            ('voile.1', 218, '        <bibl>'),
            ('voile.1', 219, '          <author>WACE</author>'),
            ('voile.1', 220, '          <biblScope>3</biblScope>'),
            ('voile.1', 221, '          <date notBefore="1101" notAfter="1200">XIIe s.</date>'),
            ('voile.1', 222, '        </bibl>'),
            ('voile.1', 223, '      </cit>'),
            ('voile.1', 224, '      <lbl>XVe s.</lbl>'),
            ('voile.1', 225, '      <cit type="example" ana="attestation">'),
            ('voile.1', 226, '        <quote>le voyle</quote>'),
            ('voile.1', 227, '        <bibl>'),
            ('voile.1', 228, '          <author>WACE</author>'),
            ('voile.1', 229, '          <biblScope>4</biblScope>'),
            ('voile.1', 230, '          <date notBefore="1401" notAfter="1500">XVe s.</date>'),
            ('voile.1', 231, '        </bibl>'),
            ('voile.1', 232, '      </cit>'),
            ('voile.1', 233, '      Sans <usg type="meaningType" norm="figurative">fig.</usg> date'),
            ('voile.1', 234, '    </etym>'),
            ('voile.1', 235, '    <xr type="synonymy"><seg>VOILE, RIDEAU. </seg><lbl>Voy.</lbl><ref type="entry" target="#rideau">RIDEAU</ref><seg>.</seg></xr>'),
            ('voile.1', 236, '    <cit type="example">'),
            ('voile.1', 237, '      <quote>synonyme cité</quote>'),
            ('voile.1', 238, '      <bibl>'),
            ('voile.1', 239, '        <author>S</author>'),
            ('voile.1', 240, '        <biblScope>5</biblScope>'),
            ('voile.1', 241, '      </bibl>'),
            ('voile.1', 242, '    </cit>'),
            ('voile.1', 243, '    <note type="proverbes">'),
            ('voile.1', 244, '      Sous le voile.'),
            ('voile.1', 245, '    </note>'),
            ('voile.1', 246, '    <note type="remarque">'),
            ('voile.1', 247, '      Genre inconnu.'),
            ('voile.1', 248, '    </note>'),
            ('voile.1', 249, '  </entry>'),
            ('voile.2', 0, '  <entry xml:id="voile.2" xml:lang="fr-x-lit19c" type="mainEntry" source="supplement">'),
            ('voile.2', 1, '    <form type="lemma">'),
            ('voile.2', 2, '      <orth norm="voile">VOILE</orth>'),
            ('voile.2', 3, '    </form>'),
            ('voile.2', 4, '    <note type="pronunciation">voi-l\' ; plusieurs disent autrement, selon les lieux</note>'),
            ('voile.2', 5, '    <gramGrp><gram type="pos">s. f. tout neuf</gram></gramGrp>'),
            ('voile.2', 6, '    <sense xml:id="voile.2_s1" n="1">'),
            ('voile.2', 7, '      <def>Toile de vent.</def>'),
            ('voile.2', 8, '    </sense>'),
            ('voile.2', 9, '  </entry>'),
        ],
    ),
    "rich_hoists": (
        "context_id VARCHAR, position VARCHAR, usg_type VARCHAR, label VARCHAR, def_excerpt VARCHAR",
        [
            ('voile.1_s1', 'single_clause', 'domain', 'terme de mode', "Pièce d'étoffe, terme de mode, qui cache."),
        ],
    ),
    "rich_pronunciations": (
        "entry_id VARCHAR, headword VARCHAR, pronunciation VARCHAR",
        [
            ('voile.2', 'VOILE', "voi-l' ; plusieurs disent autrement, selon les lieux"),
        ],
    ),
    "scan_folder": (
        "file_ord INTEGER, source_file VARCHAR, entry_ord INTEGER, kind VARCHAR, path VARCHAR, headword VARCHAR, content VARCHAR, source_line INTEGER",
        [
            (1, 'a.xml', 1, 'entry', '', 'A', None, 2),
            (1, 'a.xml', 1, 'indent', '1.1.1', None, 'y', 3),
            (1, 'a.xml', 1, 'sense', '1.1', None, 'x', 3),
            (2, 'a_prep.xml', 1, 'entry', '', 'A2', None, 2),
            (2, 'a_prep.xml', 1, 'indent', '1.1.1', None, 'y', 3),
            (2, 'a_prep.xml', 1, 'sense', '1.1', None, 'x', 3),
            (3, 'b.xml', 1, 'entry', '', 'B', None, 1),
            (3, 'b.xml', 1, 'sense', '1.1', None, 'b', 1),
        ],
    ),
    "load_patches": (
        "source_file VARCHAR, content VARCHAR, n_patches INTEGER",
        [
            ('c.xml', 'trois mot, un autre', 3),
        ],
    ),
    "load_verdicts": (
        "source_file VARCHAR, source_line INTEGER, check VARCHAR, verdict VARCHAR, state VARCHAR",
        [
            ('v.xml', 24, 'Autre', 'Figurative', 'used'),
            ('v.xml', 25, 'Pas ce texte', 'Figurative', 'used'),
            ('v.xml', 26, '', 'Nonsense', 'unknown role'),
        ],
    ),
    "load_adjudications": (
        "xml_id VARCHAR, label VARCHAR",
        [
            ('a_s1.1', 'metonymic_subsense'),
            ('b_s1.1', 'proverb'),
        ],
    ),
    "load_norms": (
        "label VARCHAR, printed VARCHAR, target VARCHAR, reading VARCHAR",
        [
            ('argot', 'argot', 'usg', 'socioCultural=slang'),
            ('familièrement', 'familièrement', 'usg', 'hint='),
            ('mot vieux', 'mot vieux', 'usg', 'temporal=old'),
            ('n. c.', 'n. c.', 'gram', 'pos=noun gender=common'),
            ('n. x.', 'n. x.', 'gram', 'pos=noun subtype=proper'),
            ('par jeu de mots', 'par jeu de mots', 'usg', 'attitude=playful'),
            ('s. m.', 's. m.', 'usg', 'hint='),
            ('seul et au duel', 'au duel', 'gram', 'number=dual'),
            ('seul et au duel', 'seul', 'gram', 'construction=alone'),
            ("terme d'art", "terme d'art", 'usg', 'domain='),
            ('x.', 'x.', 'usg', 'hint='),
        ],
    ),
    "load_languages": (
        "line VARCHAR, i INTEGER, kind VARCHAR, cit_type VARCHAR, language VARCHAR, expand VARCHAR, gloss VARCHAR, text VARCHAR",
        [
            ('du v. klg. <i>ab</i>, mot', 0, 'connector', None, None, None, None, 'du'),
            ('du v. klg. <i>ab</i>, mot', 1, 'cit', 'etymon', 'tlh-x-old', '', 'mot', None),
            ('klg. <i>ab</i>', 0, 'cit', 'cognate', 'tlh', 'klingon', '', None),
            ('lat. <i>ab</i>', 0, 'suspect', None, None, None, None, 'lat.'),
            ('lat. <i>ab</i>', 1, 'cit', 'cognate', '', None, '', None),
        ],
    ),
    "probe_verdicts": (
        "id VARCHAR, observed VARCHAR, expected VARCHAR, agrees BOOLEAN",
        [
            ('a', 'valid', 'valid', True),
            ('b', 'invalid', 'valid', False),
            ('c', 'valid', 'missing', False),
            ('d', 'missing', 'invalid', False),
        ],
    ),
    "validation_report": (
        "value VARCHAR",
        [
            ('# document-level errors',),
            ('# invalid entries',),
            ('# ranked error signatures',),
            ('/t/corpus.xml:3:1: error: header wrong',),
            ('1\tb wrong',),
            ('1\tnot well-formed XML',),
            ('2\ta wrong',),
            ('e2\tb wrong | a wrong',),
            ('e4\ta wrong',),
            ('e5\tnot well-formed XML',),
            ('invalid\t3',),
            ('total\t5',),
            ('valid\t2',),
        ],
    ),
    "corpus_fragments": (
        "entry_ord INTEGER, id VARCHAR, batch BIGINT, fragment_md5 VARCHAR",
        [
            (0, 'esque', 0, 'e84d1d2ce3acbbf02e4ee7ff9b51286a'),
            (1, 'mot_1_1', 0, '3f15cf54231625f3ce264d7529077d63'),
            (2, 'voile.1', 1, '01b1c2aa95d426796d2c277b93d34c4d'),
            (3, 'voile.2', 1, '2654d81dee123a6bb80458c4b250fa0d'),
            (4, 'mot_1_2', 2, 'c17eaa27bf109dba5149b7c150d1d5e4'),
            (5, 'mot_2', 2, '9cf4517edbae73be80a61c68f63085a7'),
            (6, 'rendre', 3, '1895d5d1ef413af4b9e9a312f940a606'),
            (7, 'venir', 3, '7da3a6141fc8efe8c88bf9bd332cbe82'),
        ],
    ),
    "tei_document": (
        "first_line VARCHAR, last_line VARCHAR, n_lines BIGINT, n_entries BIGINT, first_entry VARCHAR, n_hoists BIGINT, n_prose BIGINT",
        [
            ('<?xml version="1.0" encoding="UTF-8"?>', '</TEI>', 425, 8, '  <entry xml:id="esque" xml:lang="fr-x-lit19c" type="mainEntry">', 1, 1),
        ],
    ),
    "written_tables": (
        "table_name VARCHAR, n_rows BIGINT, columns VARCHAR",
        [
            ('citations', 5, 'citation_id,sense_id,text_plain,text_markup,author,resolved_author,reference,is_hidden'),
            ('entries', 8, 'entry_id,headword,homograph_index,pronunciation,pos,is_supplement,source_letter'),
            ('locutions', 3, 'sense_id,canonical_form'),
            ('review_queue', 50, 'review_id,entry_id,headword,phase,flag_type,reason,context,resolution,resolved_by'),
            ('rubriques', 7, 'rubrique_id,entry_id,rubrique_type,content_plain,content_markup'),
            ('senses', 76, 'sense_id,entry_id,parent_sense_id,num,indent_id,xml_id,sense_type,role,content_plain,content_markup,is_supplement,transition_type,transition_form,transition_pos,depth'),
        ],
    ),
    "stored_index": (
        "term VARCHAR, df BIGINT, cf BIGINT",
        [
            ('corbeille', 3, 3),
            ('de', 2, 3),
            ('le', 2, 3),
            ('une', 2, 2),
            ('voy', 2, 2),
        ],
    ),
    "release_manifest": (
        "n_files BIGINT, held VARCHAR",
        [
            (1, 'deux un'),
        ],
    ),
    "corrected_sample": (
        "source_file VARCHAR, source_line INTEGER, content VARCHAR",
        [
            ('v.xml', 45, 'Genre inconnu.'),
        ],
    ),
    "dict_q22_search_senses": (
        "sense_id BIGINT, headword VARCHAR, sense_type VARCHAR, content_plain VARCHAR",
        [
            (1, 'PANIER', 'sense', "Corbeille tressée d'osier."),
            (14, 'PANIER', 'cross_reference', 'Voy. CORBEILLE'),
            (15, 'PANIER', 'cross_reference', 'voy. CORBEILLE'),
        ],
    ),
    "dict_q23_search_citations": (
        "citation_id BIGINT, headword VARCHAR, resolved_author VARCHAR, reference VARCHAR, text_plain VARCHAR",
        [
            (2, 'PANIER', 'DUVAL', 'ib. 4', 'Le panier vide'),
        ],
    ),
}


def _literal(x) -> str:
    if x is None:
        return "NULL"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def sql(name: str) -> str:
    """The expected rows of a query as one SELECT."""
    columns, rows = EXPECTED[name]
    named = [c.rsplit(" ", 1) for c in columns.split(", ")]
    values = ", ".join("(" + ", ".join(_literal(x) for x in r) + ")" for r in rows)
    casts = ", ".join(f'"{c}"::{t} AS "{c}"' for c, t in named)
    names = ", ".join(f'"{c}"' for c, _ in named)
    return f"SELECT {casts} FROM (VALUES {values}) t({names})"
