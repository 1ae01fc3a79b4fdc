"""Directory pages rendered from the base tables, for round trips.

Each profile gets a card template of its markup.  People come from ``customer`` and ``nation``; the
pages are built with column expressions, so they grow with the tables, and plain SQL over the same
tables says what an extraction must return.

``{name}`` and friends are columns; ``[[..]]`` is rendered only for people with an address.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardloom.functions.sql import case, concat, lit
from cardloom.plans.profiles import BY_ID, PROFILES
from cardloom.sources.tables import parse_parts, spread, table

CARDS_PER_PAGE = 10
LINK = '<a href="mailto:{email}">{email}</a>'
NAP = " \n\t"  # leading noise around rendered names
TAIL = "\u00a0 "  # trailing noise, with a no-break space


@dataclass(frozen=True)
class Markup:
    """Card template of a profile and what an extraction must give for it."""

    card: str
    wrap: str = "<div>{cards}</div>"
    mail: str = "none"  # none: never read; kept: '' if missing; needed: no record without; always;
    # org: kept, with the suffix rewritten
    blank: str = "drop"  # what happens to a person without a name: drop | keep
    title: str = "text"  # text | none | raw (entities not decoded)
    extras: dict[str, str] = field(default_factory=dict)
    detail: str = ""  # detail page template
    detail_url: str = ""


def _fs(title="{title}", label="", mail=f"[[{LINK}]]", name='<a href="#">{name}</a>', more="",
        tag="div"):
    return (
        f'<{tag} class="fsConstituentItem col"><h3 class="fsFullName">{name}</h3>'
        f'<div class="fsTitles">{label}{title}</div>{more}<div class="fsEmail">{mail}</div></{tag}>'
    )


def _fs_kept(**kw):
    extra = {k: kw.pop(k) for k in ("blank", "title", "extras") if k in kw}
    return Markup(_fs(**kw), mail="kept", **extra)


_STAFF_CARD = (
    '<div data-testid="staff-card" class="card"><div class="staff-info"><div class="name">{name}</div>'
    '<div class="title">{title}</div><div class="phone">555-{key}</div>'
    f'<div class="email">[[{LINK}]]</div></div></div>'
)
_WIX = '<div class="wixui-rich-text">'
_MESH_LINK = '<div><p><a href="mailto:{email}"> {email}</a></p></div>'

MARKUP: dict[str, Markup] = {
    "cps": Markup(
        '<div class="promo-listing-content"><h3 class="minor">{name}</h3><p><strong>{title}</strong></p></div>',
        blank="keep",
    ),
    "chicagohopeacademy": Markup(
        f'{_WIX}<h3>{{name}}<span>{{title}}</span></h3></div>{_WIX}<p>no heading</p></div>'
    ),
    "chicagochristian": Markup(
        '<div class="content-wrap"><p><strong>{name}</strong><br>{title} [[{email}]]</p></div>'
        '<div class="content-wrap"><p><strong>Three Campuses of {last}</strong></p></div>',
        mail="kept",
    ),
    "chicagojewishdayschool": _fs_kept(label="Titles: "),
    "chicagojesuitacademy": Markup(
        '<div class="abcfslItemCntrLst"><span class="abcfslSpanMP2">{first}</span> '
        '<span class="abcfslSpanMP3">{last}</span><div class="T-F2">{title}</div>'
        '<div class="elementor-heading-title EM-F3">[[{email}]]</div></div>',
        '<div class="abcfslAjaxItems_1">{cards}</div>', mail="kept",
    ),
    "nobleschools": Markup(
        '<div class="fusion-portfolio-content"><h2 class="entry-title"><a href="/p">{name}</a></h2>'
        '<div class="fusion-post-content"><p>{title}</p><p>More</p></div></div>'
    ),
    "chicagowaldorf": Markup(
        '<div class="list-item-content__text-wrapper"><h2 class="list-item-content__title">{name}</h2>'
        '<div class="list-item-content__description"><p>Since 2001<br>[[{email}<br>]]<em>{title}</em></p>'
        "</div></div>",
        title="raw",
    ),
    "chicagocommons": Markup(
        '<h2 class="elementor-heading-title">{name}</h2>'
        '<div class="elementor-text-editor"><p><span>{title}</span></p></div>'
    ),
    "sd170": Markup(
        "<tr><td><p> </p><p>{name}</p></td><td><p></p><p>{title}</p><p>more</p></td>"
        f"<td>[[{LINK}]]</td></tr><tr><td><p>short row {{key}}</p></td></tr>",
        '<div class="table-v2-block"><table>{cards}</table></div>', mail="kept",
    ),
    "hsaswchicago": Markup(
        '<li class="staff"><div class="name-position"><span class="name">{name}</span>'
        '<span class="user-position">{title}</span></div></li>',
        '<ul id="staff_group_main">{cards}</ul>',
    ),
    "chicagoparkschool": Markup(
        '<div class="elementor-column"><div class="elementor-widget-wrap">'
        '<h2 class="elementor-heading-title">{name}</h2><h5 class="elementor-heading-title">{title}</h5>'
        f'<div class="staff-member-bio">[[{LINK}]]</div></div></div>',
        mail="kept",
    ),
    "montessoriacademychicago": Markup(
        '<div class="four columns"><p class="leadership-name"><strong>{name}</strong>'
        '[[<a href="mailto:{email_local}">mail</a>]]</p><p><em>{title}</em></p></div>',
        '<div class="three-columns">{cards}</div>', mail="org",
    ),
    "latinschool": Markup(_fs(label="Titles:<br>")),
    "chicagocollegiate": Markup(
        '<h4 class="fl-heading"><span class="fl-heading-text">{title}</span></h4>'
        '<h3 class="fl-heading"><span class="fl-heading-text">{name}</span></h3>',
        blank="keep",
    ),
    "lyceechicago": Markup(
        '<div class="fsConstituentItem"><h3 class="fsFullName"><a href="profile/{key}">open</a></h3></div>',
        mail="kept", extras=dict(department="Department {key}", image_url="/img/{key}.jpg"),
        detail='<dialog class="fsDialog" open=""><div id="fsDialogContent"><h3>{name}</h3>'
               '<img src="/img/{key}.jpg"><div>{title}</div><div>{title}</div>'
               '<div id="fsEmailRow">x</div><div>Department {key}</div>[[<div>' + LINK + "</div>]]</div></dialog>",
        detail_url="https://www.lyceechicago.org/about/profile/{key}",
    ),
    "d187": Markup(
        '<div class="staff-info"><div class="name">{name}</div><div class="title">{title}</div>'
        f'<div class="email">[[{LINK}]]</div></div>',
        mail="kept", blank="keep",
    ),
    "toddlertown": Markup(
        '<div class="elementor-widget-heading"><h2>{name}</h2></div>'
        '<div class="elementor-widget-heading"><p>no heading</p></div>'
        '<div class="elementor-widget-heading"><h3>{title}</h3></div>'
        f'<div class="elementor-widget-icon-list"><ul><li>[[{LINK}]]</li></ul></div>',
        mail="needed",
    ),
    "association_house": Markup(
        f"{_WIX}<h2>{{name}}</h2></div>{_WIX}<span>decor</span></div>{_WIX}<p>{{title}}</p></div>"
        f"{_WIX}<p>second paragraph</p></div>"
    ),
    "efac_chicago": Markup(f"<p>{{name}}, <em>{{title}}</em> [[{LINK}]]</p><p>plain, text</p>",
                           mail="needed"),
    "german_school_chicago": Markup(
        '<li class="group"><img src="/img/{key}.jpg"><span class="first-name">{first}</span>'
        '<span class="last-name">{last}</span><span class="job-title">{title}</span></li>',
        "<ul>{cards}</ul>",
        extras=dict(image_url="https://www.germanschoolchicago.com/img/{key}.jpg"),
    ),
    "british_international_ny": Markup(
        '<div class="elementor-author-box__text"><h4 class="elementor-author-box__name">{name}</h4>'
        '<div class="elementor-author-box__bio"><p>{title}</p><p>Bio</p></div></div>'
    ),
    "clarke_schools_ny": Markup(
        '<div class="card-body text-center"><h5 class="pix-member-name">{name}</h5>'
        '<span class="pix-member-title">{title}</span></div>'
    ),
    "cristo_rey_ny": Markup(
        f'<div class="wixui-box"><h3><span>{{name}}</span></h3><p>{{title}}</p><p>[[{LINK}]]</p></div>',
        mail="needed",
    ),
    "easterseals_ny": Markup(
        '<div class="card__content"><h2 class="h3"><a class="h3__link" '
        'href="https://ny.easterseals.com/people/{key}"><span>{name}</span></a></h2>'
        '<p class="card__subheading">{title}</p></div>',
        mail="kept", blank="keep",
        detail="<h1>{name}</h1>[[<a href=\"mailto:{email}\">  {email} </a>]]<a href='/x'>x</a>",
        detail_url="https://ny.easterseals.com/people/{key}",
    ),
    "german_international_ny": _fs_kept(
        title="", more='<div class="fsDepartments">{title}</div>', blank="keep"
    ),
    "greater_ny_academy": Markup(
        '<li class="staff"><div class="name-position"><a class="name" href="/apps/staff/{key}">{name}</a>'
        '<span class="user-position">{title}</span></div></li>',
        "<ul>{cards}</ul>", mail="kept", blank="keep",
        detail=f"<h1>{{name}}</h1>[[{LINK}]]", detail_url="https://www.gnya.org/apps/staff/{key}",
    ),
    "harbor_school_ny": Markup(
        f'<div><span style="color:red;font-weight:bold">{{name}}</span></div>{_MESH_LINK}'
        "<div><p>Office hours</p></div><div><p>{title}</p></div><div><p>{title}</p></div>",
        '<div data-mesh-id="x_inlineContent-gridContainer">{cards}</div>', mail="always",
    ),
    "harrow_ny": _fs_kept(),
    "keio_ny": _fs_kept(
        title="", label="Titles:", more='<div class="fsDepartments">Departments: {title}</div>', blank="keep"
    ),
    "marymount_ny": Markup(
        '<li class="member-directory-item"><h2 class="title">{name}</h2><span class="job_title"> </span>'
        f'<span class="categories">{{title}}</span><span class="email">[[{LINK}]]</span></li>',
        "<ul>{cards}</ul>", mail="kept",
    ),
    "new_york_avenue": Markup(
        '<div class="ui-article"><div class="ui-article-description"><span>'
        f"<p>{{name}}, {{title}}, Room {{key}}</p><p>[[{LINK}]]</p></span></div></div>",
        mail="kept", blank="keep",
    ),
    "new_york_elementary": _fs_kept(blank="keep"),
    "school_finder": Markup(
        '<div class="card search-result"><a class="search-result__link" href="https://finder.example.com/{key}">'
        '<h2 data-testid="search-result__title">{name}</h2></a><p>{title}</p></div>',
        title="none",
        extras=dict(profile_url="https://finder.example.com/{key}",
                    official_website="https://school{key}.example.org"),
        detail='<div class="profile__buckets"><a class="profile__website__link" '
               'href=" https://school{key}.example.org ">site</a></div>',
        detail_url="https://finder.example.com/{key}",
    ),
    "new_york_mills": Markup(
        '<div class="cs-card"><span class="cs-item-title">{name}</span><span class="cs-subtext">{title}</span>'
        '<span class="cs-subtext">Room</span><a onclick="email(\'id={key}\')">mail</a></div>',
        mail="kept", blank="keep", detail="[[ {email} ]]",
        detail_url="https://www.nymills.k12.mn.us/sys/user/email?id={key}&code=False",
    ),
    "coram_deo_dallas": Markup(
        '<a class="group" href="#"><p class="font-brand-heading">{name}</p>'
        '<div class="lg:absolute"><p class="font-normal">{title}</p></div></a>'
    ),
    "dallas_christian_academy": Markup(
        '<article><div class="staff-img">[[<a class="email" '
        "onclick=\"window.location='mailto:' + '{user}' + '@' + 'example.com'\">mail</a>]]</div>"
        '<div class="staff-title"><h3>{name}</h3><p>{title}</p></div></article>',
        '<section class="row text-center">{cards}</section>', mail="kept",
    ),
    "dallas_christian_school": Markup(
        '<div class="user-info"><a class="name" href="/apps/staff/{key}">{name}</a>'
        '<span class="user-position">{title}</span></div>',
        mail="kept", detail=f"<p>[[{LINK}]]</p>",
        detail_url="https://www.dallaschristian.com/apps/staff/{key}",
    ),
    "fusion_academy_dallas": Markup(
        '<div class="staff-item"><div class="content"><h3>{name}</h3>'
        '<p class="teacher-info-1">{title}</p></div></div>'
    ),
    "grace_academy_dallas": Markup(
        '<div class="photo"><h3>{name}, {title}</h3></div><div class="photo"><h3> </h3></div>',
        '<div id="trustees">{cards}</div>', blank="keep",
    ),
    "jesuit_dallas": _fs_kept(
        title="", name="{name}", more='<div class="fsBiography"><p></p><p>{title}<b>more</b></p></div>'
    ),
    "melcher_dallas_elementary": Markup(
        '<p><span>{title}:</span> [[<a href="mailto:{email}">{name}</a>]]</p>',
        '<div class="html-wrapper">{cards}</div>', mail="needed",
    ),
    "melcher_dallas_high": Markup(_STAFF_CARD, mail="kept", extras=dict(phone="555-{key}")),
    "pioneer_north_dallas": Markup(
        '<div class="staff-card"><div class="staff-name">{name}</div><div class="staff-title">{title}</div>'
        f'<div class="staff-contact">[[{LINK}]]</div></div>',
        mail="kept",
    ),
    "texans_can_dallas_north": Markup(_STAFF_CARD, mail="kept"),
    "texans_can_pleasant_grove": Markup(
        '<div class="contact-box"><span class="name">{name}</span><span class="title">{title}</span>'
        f'<span class="phone">555-{{key}}</span><span class="email">[[{LINK}]]</span></div>',
        mail="kept", extras=dict(phone="555-{key}"),
    ),
    "melcher_dallas_high_buttons": Markup(
        _STAFF_CARD.replace(LINK, "<button>{email}</button>"), mail="kept", extras=dict(phone="555-{key}")
    ),
    "dallas_international": _fs_kept(),
    "dallas_lutheran": _fs_kept(),
    "dallas_school_district": Markup(
        '<div class="col-lg-4"><img src="/img/{key}.jpg"><h4 class="font-18">{title}: {name}</h4></div>'
        '<div class="col-lg-4"><h4 class="font-18"> </h4></div>',
        '<div class="b_members">{cards}</div>', blank="keep", extras=dict(image_url="/img/{key}.jpg"),
    ),
    "miami_middle": Markup(
        '<div class="fsElement fsSingleItem"><header><h2><strong>{name}</strong></h2>'
        f'<span class="fs_style_1">{{title}}</span></header><footer>[[{LINK}]]</footer></div>',
        mail="kept",
    ),
    "hamilton_city": _fs_kept(
        label="Titles: ", more='<div class="fsLocations">Locations: Room {key}</div>',
        extras=dict(location="Room {key}"),
    ),
    "little_miami_board": Markup(
        f'<div class="card-container"><strong>{{name}} – {{title}}</strong>[[{LINK}]]</div>', mail="kept"
    ),
    "miami_arts_charter": Markup('<a href="/staff/{key}"><h3>{name}</h3><p>{title}</p><p>x</p></a>'),
    "miami_dade_board": Markup(
        '<div class="card mx-auto full-height"><h4 class="text-center">{name}</h4>'
        f'<h4 class="text-center">District</h4><h5 class="text-uppercase">{{title}}</h5>[[{LINK}]]</div>',
        mail="kept",
    ),
    "miami_east": Markup(_STAFF_CARD, mail="kept"),
    "miami_jr_high": Markup(
        '<div class="elementor-column"><div class="elementor-widget-heading"><h3>{name}</h3></div>'
        '<div class="elementor-widget-heading"><h2>section</h2></div>'
        f'<div class="elementor-widget-text-editor"><em>{{title}}</em>[[{LINK}]]</div></div>',
        mail="kept",
    ),
    "miami_lakes_k8": Markup(
        '<a href="/apps/staff/?uREC_ID={key}"><dl><dt>{name}</dt><dd>{title}</dd></dl></a>',
        '<div id="staff">{cards}</div>',
        extras=dict(profile_url="https://mlk8center.org/apps/staff/?uREC_ID={key}"),
    ),
    "miami_r1": Markup(
        '<div class="paragraph">{title}<a [[href="mailto:{email}"]]>{name}</a><br>tail text<b>x</b></div>',
        '<table><tr><td class="wsite-multicol-col">{cards}</td></tr></table>', mail="kept", blank="keep",
    ),
    "miami_springs_middle": Markup(
        '<figcaption class="wpzabb-member-caption"><span class="wpzabb-member-name-text">{name}</span>'
        f'<span class="wpzabb-member-position">{{title}}</span>[[{LINK}]]</figcaption>',
        mail="kept", blank="keep",
    ),
    "muasda": Markup(
        '<div class="staff_title"><h2 class="elementor-heading-title">{name}</h2></div>',
        title="none", blank="keep",
    ),
    "new_miami_high": _fs_kept(label="Titles: "),
    "slam_miami": Markup(
        '<li class="staff-categoryStaffMember"><a href="/apps/staff/{key}"><dl class="staffPhotoWrapperRound">'
        "<dt>{name}</dt><dd>{title}</dd></dl></a></li>",
        '<ul class="staff-categoryStaffMembers">{cards}</ul>',
        extras=dict(profile_url="https://www.slammiami.com/apps/staff/{key}"),
    ),
    "tamim_miami": Markup(
        '<div class="sc_team_item_info"><h5 class="sc_team_item_title"><a href="#">{name}</a></h5>'
        f'<div class="sc_team_item_position"><p>{{title}}</p></div>[[{LINK}]]</div>',
        mail="kept", blank="keep",
    ),
    "greater_miami_adventist": Markup(
        f'<div class="xr_txt Heading_4 xr_bold"><span>{{name}}</span><span>{{title}}</span>[[{LINK}]]</div>',
        mail="kept", blank="keep",
    ),
    "mater_miami_beach": Markup(
        '<div class="staff-categoryStaffMember"><a href="/apps/staff/{key}"><dl><dt>{name}</dt>'
        "<dd>{title}</dd></dl></a></div>",
        '<div class="staff-category"><h2 class="staff-header"> Teachers </h2>{cards}</div>', blank="keep",
        extras=dict(category="Teachers", profile_url="https://www.materbeach.com/apps/staff/{key}"),
    ),
    "miami_elementary": _fs_kept(
        title="ignored", more='<div class="fsLocations">Room {key}</div>', extras=dict(location="Room {key}"),
    ),
    "white_settlement": _fs_kept(label="Titles:"),
    "bridges_seattle": Markup(
        '<div class="elementor-widget-image-box"><h3 class="elementor-image-box-title">{name}</h3>'
        '<p class="elementor-image-box-description">"{title}"</p></div>'
    ),
    "brightmont_seattle": Markup(
        '<div class="photogallery-column"><div class="caption-title">{name}</div>'
        '<div class="caption-text"><div class="rteBlock">{title}</div><div class="rteBlock">x</div></div></div>',
        blank="keep",
    ),
    "cristo_rey_seattle": Markup(
        _fs(mail="", more='<div class="fsViewProfileLink"><a href="../people/{key}">view</a></div>'),
        mail="kept", blank="keep",
        detail=f"<div>[[{LINK}]]</div>", detail_url="https://www.cristoreyseattle.org/people/{key}",
    ),
    "derech_emunah": Markup(
        '<div class="teachers-item"><div class="teachers-item-info"><h3>{name}</h3><p>{title}</p><p>x</p>'
        "</div></div>"
    ),
    "north_seattle_french": Markup(
        '<div class="awsm-team-item"><div class="awsm-personal-info"><h3>{name}</h3><span>{title}</span>'
        "<span>x</span></div></div>"
    ),
    "northwest_montessori": Markup(
        '<div class="staff-member"><div class="staff-member-info-wrap"><strong>"{name}"</strong>\n{title_line}\n'
        '[[<a class="staff-member-email" href="mailto:{email}">mail</a>]]</div></div>',
        mail="kept",
    ),
    "seattle_academy": Markup(
        f'<div class="fsConstituentCustom"><div class="fsFullName"><a href="#">{{name}}</a></div>[[{LINK}]]</div>'
        '\n<div class="fsElement"><h6>{title}</h6></div>',
        mail="kept", blank="keep",
    ),
    "seattle_amistad": Markup(
        '<li class="list-item-content"><h2 class="list-item-content__title">{name}</h2>'
        '<div class="list-item-content__description"><p>"{title}"</p><p>x</p></div></li>',
        "<ul>{cards}</ul>",
    ),
    "seattle_christian": _fs_kept(),
    "seattle_classical_christian": Markup(
        "<p><strong>{name}</strong> {title}</p>", '<div class="sqs-html-content">{cards}</div>'
    ),
    "seattle_german_american": Markup("<button><p>{name}</p><p>{title}</p></button>"),
    "seattle_girls": Markup(
        '<li class="group"><span class="first-name">{first} </span><span class="last-name">{last}</span>'
        '<span class="job-title">{title}</span></li>',
        "<ul>{cards}</ul>",
    ),
    "seattle_hill": _fs_kept(title="ignored"),
    "seattle_jewish_community": Markup(_fs()),
    "seattle_prep": _fs_kept(),
    "seattle_nativity": Markup(
        '<td><div class="paragraph"><font>{name}<br><em>"{title}"</em></font></div></td>',
        '<table class="wsite-multicol-table"><tr>{cards}</tr></table>', blank="keep",
    ),
    "seattle_public": Markup('<div class="wp-block-column"><h4>{name}</h4><p>{title}</p></div>', blank="keep"),
    "settles_bridge": Markup(
        '<tr><td>{last}</td><td>{first}</td><td>{title}</td><td>[[<a href="#">{email}</a>]]</td></tr>',
        "<table><tbody>{cards}</tbody></table>", mail="kept", blank="keep", title="none",
    ),
}
# Titles these profiles do not read although the page shows them.
UNREAD_TITLES = frozenset(["miami_elementary", "seattle_hill"])


def title_mode(profile_id: str) -> str:
    return "none" if profile_id in UNREAD_TITLES else MARKUP[profile_id].title


# --- people ----------------------------------------------------------------------------------
def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One person per customer; every 11th has no name, every 7th no address."""
    customer = spread(table(spark, sf_dir, "customer"))
    nation = table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    named = key % 11 != 5
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        key.alias("key"),
        F.when(named, F.initcap(F.lower("c_mktsegment"))).otherwise("").alias("first"),
        F.when(named, F.col("c_name")).otherwise("").alias("last"),
        F.concat(F.lit("Director of "), F.col("n_name"), F.lit(" & Co")).alias("title"),
        F.concat(F.regexp_replace(F.lower("c_name"), "#", "."), F.lit("@example.com")).alias("email"),
        (key % 7 != 3).alias("has_email"),
        F.col("n_nationkey").alias("nation_key"),
        "n_name",
    )


# the same people for DuckDB
PEOPLE_SQL = """people AS (
  SELECT c_custkey AS key,
         CASE WHEN c_custkey % 11 <> 5
              THEN upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) ELSE '' END AS first,
         CASE WHEN c_custkey % 11 <> 5 THEN c_name ELSE '' END AS last,
         trim(CASE WHEN c_custkey % 11 <> 5
              THEN upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' ' || c_name
              ELSE '' END) AS name,
         'Director of ' || n_name || ' & Co' AS title,
         replace(lower(c_name), '#', '.') || '@example.com' AS email,
         c_custkey % 7 <> 3 AS has_email,
         n_nationkey AS nation_key, n_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _values() -> dict[str, str]:
    noisy = lambda x: f"if(last <> '', concat({lit(NAP)}, {x}, {lit(TAIL)}), ' ')"
    markup_title = "replace(title, '&', '&amp;')"
    return {
        "name": noisy("concat_ws(' ', first, last)"),
        "first": noisy("first"),
        "last": "last",
        "title": f"concat({lit(chr(10) + ' ')}, {markup_title}, ' ')",
        "title_line": markup_title,
        "email": "email",
        "email_local": "replace(email, '.com', '.localhost.me')",
        "user": "split_part(email, '@', 1)",
        "key": "CAST(key AS STRING)",
    }


def fill(template: str, values: dict[str, str]) -> str:
    """Template -> string expression."""

    def plain(text: str) -> list[str]:
        pieces = re.split(r"\{(\w+)\}", text)
        return [
            values[piece] if i % 2 else lit(piece)
            for i, piece in enumerate(pieces)
            if i % 2 or piece
        ]

    parts: list[str] = []
    for i, block in enumerate(re.split(r"\[\[(.*?)\]\]", template, flags=re.S)):
        if i % 2:
            parts.append(f"if(has_email, {concat(*plain(block))}, '')")
        else:
            parts.extend(plain(block))
    return concat("''", *parts)


def _by_profile(value, ids) -> Column:
    """One WHEN per profile."""
    return F.expr(case(*[(f"profile_id = {lit(i)}", value(i)) for i in ids]))


def _html(body: Column) -> Column:
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>Staff</title></head><body>"), body,
        F.lit("</body></html>"),
    )


def assigned_people(spark: SparkSession, sf_dir: str, ids: tuple[str, ...]) -> DataFrame:
    """People spread over the given profiles."""
    names = F.expr("array(" + ", ".join(lit(i) for i in ids) + ")")
    return people(spark, sf_dir).withColumn(
        "profile_id", F.get(names, (F.col("key") % len(ids)).cast("int"))
    ).withColumn("n", F.floor(F.col("key") / len(ids)))


def listing_pages(spark: SparkSession, sf_dir: str, ids: tuple[str, ...]) -> DataFrame:
    """``CARDS_PER_PAGE`` people per page, so a page stays small however many people there are."""
    values = _values()
    cards = assigned_people(spark, sf_dir, ids).select(
        "profile_id",
        (F.floor(F.col("n") / CARDS_PER_PAGE) + 1).cast("int").alias("page_no"),
        "key",
        _by_profile(lambda i: fill(MARKUP[i].card, values), ids).alias("card"),
    )
    dealt = cards.repartition(parse_parts(spark), "profile_id", "page_no")
    pages = dealt.groupBy("profile_id", "page_no").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("key", "card"))), lambda c: c["card"]), "\n"
        ).alias("cards")
    )
    body = _by_profile(lambda i: fill(MARKUP[i].wrap, {"cards": "cards"}), ids)
    base = _by_profile(lambda i: lit(BY_ID[i].url), ids)
    return pages.select(
        F.col("profile_id").alias("source_id"), "profile_id", F.lit("listing").alias("role"), "page_no",
        F.when(F.col("page_no") == 1, base).otherwise(
            F.concat(base, F.lit("?page="), F.col("page_no").cast("string"))
        ).alias("url"),
        _html(body).alias("html"),
    )


def detail_pages(spark: SparkSession, sf_dir: str, ids: tuple[str, ...],
                 missing_every: int = 13) -> DataFrame:
    """One page per person of the profiles with a lookup; every 13th was never stored."""
    looked_up = tuple(i for i in ids if MARKUP[i].detail)
    values = _values()
    persons = assigned_people(spark, sf_dir, ids).filter(
        F.col("profile_id").isin(*looked_up) & (F.col("key") % missing_every != 0)
    )
    return persons.select(
        F.col("profile_id").alias("source_id"), "profile_id", F.lit("detail").alias("role"),
        F.lit(1).alias("page_no"),
        _by_profile(lambda i: fill(MARKUP[i].detail_url, values), looked_up).alias("url"),
        _html(_by_profile(lambda i: fill(MARKUP[i].detail, values), looked_up)).alias("html"),
    )


ALL_IDS = tuple(p.profile_id for p in PROFILES)


def expected_sql(ids: tuple[str, ...], select: str, missing_every: int = 13) -> str:
    """What extraction must return, from the base tables alone."""
    q = lambda s: "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    extras = ("image_url", "department", "phone", "location", "category", "profile_url", "official_website")
    rows = ",\n    ".join(
        "("
        + ", ".join(
            [str(n), q(i), q(BY_ID[i].school_name), q(BY_ID[i].url), str(BY_ID[i].url_per_page),
             q(MARKUP[i].mail), q(MARKUP[i].blank), q(title_mode(i)), str(bool(MARKUP[i].detail)),
             q(BY_ID[i].lookup.how if BY_ID[i].lookup else None)]
            + [q(MARKUP[i].extras.get(e)) for e in extras]
        )
        + ")"
        for n, i in enumerate(ids)
    )
    filled = ",\n         ".join(
        f"coalesce(replace({e}, '{{key}}', CAST(key AS VARCHAR)), '') AS {e}" for e in extras[:-1]
    )
    return f"""WITH {PEOPLE_SQL},
traits(source_ord, profile_id, school_name, base_url, url_per_page, mail, blank, title_mode, has_detail, how,
       {', '.join(extras)}) AS (VALUES
    {rows}),
cards AS (
  SELECT t.*, p.*, CAST(floor(floor(p.key / {len(ids)}) / {CARDS_PER_PAGE}) AS INTEGER) + 1 AS page_no,
         (NOT has_detail OR p.key % {missing_every} <> 0) AS stored
  FROM people p JOIN traits t ON p.key % {len(ids)} = t.source_ord),
expected AS (
  SELECT source_ord, profile_id, page_no, key, school_name,
         CASE WHEN url_per_page AND page_no > 1 THEN base_url || '?page=' || CAST(page_no AS VARCHAR)
              ELSE base_url END AS url,
         name,
         CASE title_mode WHEN 'none' THEN '' WHEN 'raw' THEN replace(title, '&', '&amp;')
              ELSE title END AS job_title,
         CASE WHEN mail = 'none' OR NOT stored OR (mail <> 'always' AND NOT has_email) THEN ''
              WHEN mail = 'org' THEN replace(email, '.com', '.org') ELSE email END AS email,
         {filled},
         CASE WHEN stored THEN coalesce(replace(official_website, '{{key}}', CAST(key AS VARCHAR)), '')
              ELSE '' END AS official_website
  FROM cards
  WHERE NOT (blank = 'drop' AND name = '') AND NOT (mail = 'needed' AND NOT has_email)
    AND NOT (coalesce(how, '') = 'inner' AND NOT stored))
{select}"""
