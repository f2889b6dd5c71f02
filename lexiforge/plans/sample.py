"""Two small dictionaries of our own: one for the documented questions, one that holds every role, rubrique and flag."""

FILE = "p.xml"

TEXT = """<xmllittre>
<entree terme="PANIER" sens="1">
<entete><prononciation>pa-nié</prononciation><nature>s. m.</nature></entete>
<corps>
<variante num="1">Corbeille tressée d'osier.
<cit aut="DUVAL" ref="Récits, 3">Un panier plein</cit>
<cit aut="ID." ref="ib. 4" hide="x">Le panier vide</cit>
<indent>Fig. Une troupe de gens.<cit aut="" ref="anon.">Vieux dire</cit></indent>
<indent><semantique type="domaine">Terme de marine.</semantique> Abri de mât.</indent>
<indent><exemple>Le dessus du panier</exemple>, le meilleur choix.<cit aut="ID." ref="ib. 9">Encore lui</cit></indent>
<indent>Proverbialement. Adieu paniers, se dit quand tout est perdu.</indent>
<indent>Une chose sans règle.</indent>
<indent>Absolument.</indent>
</variante>
<variante num="2">Le contenu.</variante>
<variante num="3">La mesure.<indent><nature>Au pluriel.</nature></indent><indent>Grandes jupes.</indent><indent>Familièrement, bagages.</indent></variante>
</corps>
<rubrique nom="HISTORIQUE">XIIe s.<indent>Vieux texte<cit aut="MARIN" ref="1">Panier en main</cit></indent></rubrique>
<rubrique nom="ÉTYMOLOGIE">Lat. <i>panarium</i>, corbeille à pain ; zzz. <i>pana</i></rubrique>
</entree>
<entree terme="PANIER" sens="2" supplement="1"><entete><nature>v. a.</nature></entete><corps><variante>Voir &amp; mettre.<indent><a ref="corbeille.1">Voy. CORBEILLE</a></indent><indent>voy. <a ref="corbeille">CORBEILLE</a></indent></variante></corps></entree>
<entree terme="ÉCLAT"><corps><variante num="1">Morceau.<indent><exemple>S'ÉCLATER</exemple>, v. réfl.</indent></variante><variante num="2">Bruit.</variante></corps></entree>
<entree terme="ÉCLAT"><corps><variante num="1">Lueur.</variante></corps><rubrique nom="SUPPLÉMENT AU DICTIONNAIRE">Ajout<variante num="2">Rayon.</variante></rubrique></entree>
</xmllittre>"""

RICH_1 = """<?xml version="1.0" encoding="UTF-8"?>
<xmllittre>
<entree terme="VOILE" sens="1">
<entete><prononciation>voi-l'</prononciation><nature>s. m.</nature></entete>
<corps>
<variante num="1"><semantique type="domaine">Terme de couture.</semantique> Pièce d'étoffe, <semantique type="domaine">terme de mode</semantique>, qui cache.
<cit aut="MARIN" ref="Odes, 2">Un voile <i>blanc</i></cit>
<cit aut="" ref="">sans auteur</cit>
<indent>Fig. Ce qui cache. <cit aut="ID." ref="ib." hide="1">le voile de la nuit</cit>
<indent>Une nuance plus fine.</indent></indent>
<indent><semantique type="indicateur">Fig.</semantique> Apparence trompeuse.</indent>
<indent><semantique type="domaine">Terme d'anatomie</semantique></indent>
<indent><semantique type="domaine">Terme de botanique.</semantique> Membrane.</indent>
<indent>Familièrement et par dénigrement, personne voilée.</indent>
<indent>Vieilli.</indent>
<indent><exemple>Lever le voile</exemple>, montrer la vérité. <i>Lever le voile</i> <i>sur tout</i>.<cit aut="ID." ref="ib. 4">il leva le voile</cit><indent>Sous-bloc.</indent></indent>
<indent><exemple>Prendre le voile</exemple>, la coutume des nonnes.</indent>
<indent><exemple>Voile du palais</exemple>, la cloison de la bouche.</indent>
<indent>Proverbialement. Petit voile cache grand mal, c'est-à-dire peu suffit.</indent>
<indent>Prov. Tout voile tombe.</indent>
<indent>Voy. <a ref="robe.2#s1">ROBE</a> et <a ref="Étoffe">ÉTOFFE</a>.<cit aut="X" ref="y">perdu</cit></indent>
<indent>Une chose que nulle règle ne dit.</indent>
<indent>Locution sans marque</indent>
<indent>Autre chose, dite par verdict.</indent>
<indent>Encore une, dont le contrôle ne va pas.</indent>
</variante>
<variante num="2" option="résumé">Étoffe légère.
<indent>SE VOILER, <nature>v. réfl.</nature> Se cacher.</indent>
<indent>Bloc un.</indent><indent>Bloc deux.</indent><indent>Bloc trois.</indent><indent>Bloc quatre.</indent><indent>Bloc cinq.</indent><indent>Bloc six.</indent>
<indent>S'envoiler, <nature>v. réfl.</nature> Se courber.</indent>
<indent>À voile, <nature>loc. adv.</nature> Par le vent.</indent>
<indent><nature>Au plur.</nature></indent>
<indent>Substantivement, le voilé.</indent>
<indent>Absolument.</indent>
</variante>
<variante num="3">Premier sens porté.</variante>
<variante>Second sens porté.<indent>Un bloc simple.</indent><indent>Neutralement.</indent></variante>
<variante num="5">Un sens seul.<rubrique nom="REMARQUE">Note du sens, <nature>absolument</nature>.</rubrique><indent>S'ENVOILER, v. réfl. Se plier.</indent></variante>
<variante num="6">Sous la forme.</variante>
</corps>
<rubrique nom="REMARQUES">Ce mot <semantique>fig.</semantique> voy. <a ref="robe">ROBE</a>.<indent>Autre <i lang="la">velum</i>.<cit aut="R" ref="1">remarque citée</cit></indent></rubrique>
<rubrique nom="HISTORIQUE">XIIe s.<cit aut="WACE" ref="3">li voiles</cit><indent>XVe s.<cit aut="ID." ref="4">le voyle</cit></indent><indent>Sans <semantique type="indicateur">fig.</semantique> date<indent>trop profond</indent></indent></rubrique>
<rubrique nom="SYNONYME">VOILE, RIDEAU. Voy. <a ref="rideau">RIDEAU</a>.<cit aut="S" ref="5">synonyme cité</cit></rubrique>
<rubrique nom="PROVERBE">Sous le voile.</rubrique>
<rubrique nom="INCONNU">Kind inconnu.</rubrique>
<rubrique nom="ÉTYMOLOGIE">Provenç. et esp. <i>vel</i>, voile ; du lat. fictif <i>velum</i>, toile ; orig. douteuse <i>bel</i> ; re πέπλος ; voy. <a ref="velours.2">VELOURS</a><indent><b>gras</b> <i>x</i></indent></rubrique>
<résumé><variante num="1">Résumé du <i>sens</i></variante></résumé>
</entree>
<entree terme="VOILE" sens="2" supplement="1"><entete><prononciation>voi-l' ; plusieurs disent autrement, selon les lieux</prononciation><nature>s. f. tout neuf</nature></entete><corps><variante num="1">Toile de vent.</variante></corps></entree>
<entree terme="MOT"><corps><variante>Une chose dite.</variante></corps></entree>
<entree terme="MOT"><corps><variante>Une autre.</variante></corps></entree>
</xmllittre>"""

RICH_2 = """<xmllittre>
<entree terme="-ESQUE"><entete><nature>suffixe</nature></entete><corps><variante num="1">Fin de <span lang="la">verbum</span>.</variante></corps><rubrique nom="SUPPLÉMENT AU DICTIONNAIRE"><variante num="2">Ajouté.<indent>Absolument.</indent></variante><variante num="3">Ajouté après.</variante></rubrique></entree>
<entree terme="MOT_1"><corps><variante num="1">Choc de noms.<indent>Absolument.</indent></variante><variante num="2">Adjectivement, porté.<indent>Substantivement.</indent></variante><variante num="3">Porté enfin.</variante></corps></entree>
</xmllittre>"""

#: A strong group, a valency group over more than fifteen senses, a locution without a form.
RICH_3 = """<xmllittre>
<entree terme="RENDRE"><entete><nature>v. a.</nature></entete><corps>
<variante num="1">Remettre.
<indent>Dit sans virgule ni forme</indent>
<indent>Rendre gorge, vomir.</indent>
<indent>SE RENDRE, v. réfl. Aller.</indent></variante>
<variante num="2">Céder.<indent>Fig. Se donner.</indent></variante>
</corps></entree>
<entree terme="VENIR"><corps>
<variante num="1">Arriver.<indent>V. n.</indent></variante>
"""
RICH_3 += "\n".join(f'<variante num="{i}">Sens {i}.</variante>' for i in range(2, 19)) + "\n</corps></entree></xmllittre>"

FILES = {"small": [(FILE, TEXT)], "rich": [("/in/v.xml", RICH_1), ("/in/a_prep.xml", RICH_2), ("/in/w.xml", RICH_3)]}
#: Corrections by file name and line.
PATCHES = {"rich": [{"file": "v.xml", "line": 45, "old": "Kind", "new": "Genre"}]}
VERDICTS = [("v.xml", 24, "Autre chose", "RegisterLabel", 1), ("v.xml", 24, "Autre", "Figurative", 2), ("v.xml", 25, "Pas ce texte", "Figurative", 3), ("v.xml", 9999, "", "Proverb", 4), ("w.xml", 4, "Dit sans", "Locution", 5), ("w.xml", 5, "", "Locution", 6), ("w.xml", 6, "SE RENDRE", "VoiceTransition", 7)]
ADJUDICATIONS = [("voile.1_s1.9", "metonymic_subsense"), ("voile.1_s1.8", "idiom")]
