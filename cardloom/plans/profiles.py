"""The extraction rules of all directories, as data.

Names, addresses, selectors and labels are fixed values: they describe the markup of each
directory and the constants its records carry.
"""

from __future__ import annotations

from cardloom.operators.rules import Checked, Joined, Lookup, Paging, Pick, Profile

MAIL = "a[href^='mailto:']"
FS = ".fsConstituentItem"
TEST_ID = "[data-testid='staff-card']"
TITLES, DEPARTMENTS, LOCATIONS = "Titles:", "Departments:", "Locations:"


def every(css, *steps, **kw):
    """Text of all matches, joined."""
    return (Pick(css, "all", steps=steps or ("clean",), **kw),)


def one(css, *steps, **kw):
    """Text of the first match."""
    return (Pick(css, "first", steps=steps or ("clean",), **kw),)


def nth(css, n, *steps, **kw):
    return (Pick(css, n, steps=steps or ("clean",), **kw),)


def mail(css=MAIL, *steps):
    """Address in the first link's target."""
    return (Pick(css, "first", "attr:href", steps=("strip_mailto", *steps)),)


def own(*steps, **kw):
    """The card element itself."""
    return (Pick(None, "all", steps=steps or ("clean",), **kw),)


def target(css, *steps, attr="href"):
    return (Pick(css, "first", f"attr:{attr}", steps=steps),)


def either(*fields):
    """First non-blank of several fields."""
    return tuple(p for f in fields for p in f)


def without_label(css, label, *steps, which="all", take="text"):
    return (Pick(css, which, take, steps=(("remove_first", label), *(steps or ("clean",)))),)


def columns(*pairs):
    return tuple((p, p) if isinstance(p, str) else p for p in pairs)


_DETAIL_TEXT_MAIL = (
    Checked(
        (
            Pick(MAIL, "first", scope="page"),
            Pick("a[href*='@']", "first", scope="page"),
        ),
        ("if_address",),
    ),
)
_DETAIL_HREF_MAIL = (Pick(MAIL, "first", "attr:href", scope="page", steps=("strip_mailto", "trim")),)
_SCHOOL_TITLE = columns(("school", "school_name"), "name", ("title", "job_title"), "email")
_DIALOG = (("dialog.fsDialog[open]", 0), ("[id*='DialogContent']", 0))
_DIALOG_LINE = dict(
    css="div[id*='DialogContent'] > div", scope="page", inside=_DIALOG,
    where=(("plain_text", 100), ("id_lacks", "Email")),
)
_SEA_PREP = "https://www.seaprep.org/about-prep/directory"
_SEA_PREP_FIELDS = dict(
    name=every(".fsFullName a", "trim"), job_title=every(".fsTitles", "trim"), email=mail(MAIL, "trim")
)
_PAGE_LINKS = Paging("max_attr", ".fsElementPagination a[data-page]", bare_first=True)

PROFILES: tuple[Profile, ...] = (
    # --- merge run ---------------------------------------------------------------------------
    Profile(
        "cps", "cps", "https://www.cps.edu/about/leadership/executive-leadership/",
        ".promo-listing-content", dict(name=every("h3.minor"), job_title=every("strong")), keep=(),
        merged=True,
    ),
    Profile(
        "chicagohopeacademy", "chicagohopeacademy", "https://www.chicagohopeacademy.net/faculty-staff",
        "[class*='wixui-rich-text']",
        dict(name=every("h3", take="own"), job_title=every("h3 span")),
        card_where=(("has", "h3"),), merged=True,
    ),
    Profile(
        "chicagochristian", "chicagochristian", "https://www.chicagochristian.org/about", "strong",
        dict(
            name=own(),
            job_title=either(
                one("em", scope="parent"),
                (Pick(None, take="without:strong", scope="parent",
                      steps=("clean", "drop_emails", "trim", "first_segment", "clean")),),
            ),
        ),
        group=".content-wrap",
        group_fields=dict(
            email=(Pick(None, take="outer_html", steps=("find_email",)),
                   Pick(None, steps=("find_email",)))
        ),
        keep=("person", "name"), dedup=True, merged=True,
    ),
    Profile(
        "chicagojewishdayschool", "chicagojewishdayschool",
        "https://www.chicagojewishdayschool.org/about/faculty-and-staff", FS,
        dict(
            name=one("h3.fsFullName a"),
            job_title=without_label(".fsTitles", TITLES, which="first"),
            email=one(f".fsEmail {MAIL}", "trim"),
        ),
        merged=True,
    ),
    Profile(
        "chicagojesuitacademy", "chicagojesuitacademy",
        "https://www.chicagojesuitacademy.org/about-us/faculty-and-staff/",
        ".abcfslAjaxItems_1 .abcfslItemCntrLst",
        dict(
            name=(Joined((Pick(".abcfslSpanMP2", "first"), Pick(".abcfslSpanMP3", "first"))),),
            job_title=one(".T-F2"),
            email=one(".elementor-heading-title.EM-F3"),
        ),
        merged=True,
    ),
    Profile(
        "nobleschools", "nobleschools", "https://nobleschools.org/noble-leadership/",
        ".fusion-portfolio-content",
        dict(name=one("h2.entry-title a"), job_title=one(".fusion-post-content p")), merged=True,
    ),
    Profile(
        "chicagowaldorf", "chicagowaldorf", "https://www.chicagowaldorf.org/facultyadministration",
        ".list-item-content__text-wrapper",
        dict(
            name=one(".list-item-content__title"),
            job_title=one(".list-item-content__description p", "last_html_line", "strip_tags", "clean",
                          take="inner_html"),
        ),
        merged=True,
    ),
    Profile(
        "chicagocommons", "chicagocommons", "https://www.chicagocommons.org/leadership/", shape="zip",
        blocks=dict(name=".elementor-heading-title", title=".elementor-text-editor p span"),
        merged=True,
    ),
    Profile(
        "sd170", "sd170", "https://www.sd170.com/page/board-members",
        ".table-v2-block table tbody tr",
        dict(
            name=(Pick("p", "first_text", inside=(("td", 0),)),),
            job_title=(Pick("p", "first_text", inside=(("td", 1),)),),
            email=(Pick(MAIL, "first", inside=(("td", 2),)),),
        ),
        card_where=(("at_least", "td", 2),), merged=True,
    ),
    Profile(
        "hsaswchicago", "hsaswchicago", "https://www.hsaswchicago.org/apps/staff/",
        "#staff_group_main li.staff",
        dict(name=one(".name-position .name"), job_title=one(".user-position")), merged=True,
    ),
    Profile(
        "chicagoparkschool", "chicagoparkschool", "https://chicagoparkschool.org/staff/",
        ".elementor-column .elementor-widget-wrap",
        dict(
            name=one("h2.elementor-heading-title"), job_title=one("h5.elementor-heading-title"),
            email=mail(f".staff-member-bio {MAIL}", "clean"),
        ),
        merged=True,
    ),
    Profile(
        "montessoriacademychicago", "montessoriacademychicago",
        "https://montessoriacademychicago.org/about/leadership/", ".three-columns .four.columns",
        dict(
            name=one(".leadership-name b, .leadership-name strong"), job_title=one("p em"),
            email=mail(f".leadership-name {MAIL}", "trim", ("replace_first", ".localhost.me", ".org")),
        ),
        merged=True,
    ),
    Profile(
        "latinschool", "latinschool",
        "https://www.latinschool.org/about-us/facultystaff?utf8=%E2%9C%93&const_search_group_ids=229"
        "&const_search_role_ids=1&const_search_keyword=&const_search_first_name="
        "&const_search_last_name=&const_search_department=",
        FS,
        dict(
            name=one(".fsFullName a"),
            job_title=without_label(".fsTitles", TITLES, which="first", take="visible"),
        ),
        paging=Paging(
            "next_link",
            ".fsPaginationNext, a.fsElementPaginationNext, .fsLoadMore a, "
            ".fsPagination a[aria-label='Next']",
        ),
        merged=True,
    ),
    Profile(
        "chicagocollegiate", "chicagocollegiate",
        "https://chicagocollegiate.org/our-team/our-network-leadership/", shape="zip",
        blocks=dict(name="h3.fl-heading .fl-heading-text", title="h4.fl-heading .fl-heading-text"),
        keep=(), merged=True,
    ),
    Profile(
        "lyceechicago", "lyceechicago", "https://www.lyceechicago.org/about/faculty-staff",
        f"{FS} .fsFullName a",
        dict(lookup_key=target(None, ("resolve", "https://www.lyceechicago.org/about/faculty-staff"))),
        keep=("all_of", "lookup_key"),
        lookup=Lookup(
            how="inner",
            fields=dict(
                name=(Pick("h3, h2, h1, [role='heading']", "first", scope="page", inside=_DIALOG),),
                job_title=(Pick(which="first", **_DIALOG_LINE),),
                department=(Pick(which="first_other", **_DIALOG_LINE),),
                email=(Pick(MAIL, "first", "attr:href", scope="page", inside=_DIALOG,
                            steps=("strip_mailto", "clean")),),
                image_url=(Pick("img", "first", "attr:src", scope="page", inside=_DIALOG, steps=()),),
            ),
        ),
        columns=columns("school_name", "url", "name", "job_title", "department", "email",
                        ("image", "image_url")),
        merged=True,
    ),
    Profile(
        "d187", "d187", "https://www.d187.org/staff", ".staff-info",
        dict(name=one(".name"), job_title=one(".title"), email=one(f".email {MAIL}")), keep=(),
        paging=Paging("hrefs", "nav.cms-pagination ul li a[href*='page_no']", query="?page_no="),
        url_per_page=True, merged=True,
    ),
    Profile(
        "toddlertown", "toddlertown", "https://toddlertownchildrenslearningacademy.com/meet-our-staff/",
        shape="heading_list", keep=(),
        blocks=dict(heading_block=".elementor-widget-heading",
                    list_block=".elementor-widget-icon-list", heading="h1, h2, h3"),
        merged=True,
    ),
    Profile(
        "association_house", "association_house", "https://www.associationhouse.org/executive-staff",
        ".wixui-rich-text", shape="heading_text", keep=(),
        blocks=dict(heading="h1, h2, h3", text="p"), merged=True,
    ),
    Profile(
        "efac_chicago", "efac_chicago", "https://www.efachicago.org/en/board-of-trustees/", "p",
        dict(name=own("clean", "before_comma"), job_title=one("em, i"), email=mail(MAIL, "clean")),
        card_where=(("text_has", ","), ("has", MAIL)), keep=("all_of", "name", "email"), merged=True,
    ),
    Profile(
        "german_school_chicago", "german_school_chicago",
        "https://www.germanschoolchicago.com/about/faculty-and-staff", "li.group",
        dict(
            name=(Joined((Pick(".first-name", "first"), Pick(".last-name", "first"))),),
            job_title=one(".job-title"),
            image_url=target("img", ("resolve", "https://www.germanschoolchicago.com/about/faculty-and-staff"),
                             attr="src"),
        ),
        columns=columns("school_name", "url", "name", "job_title", "email", "image_url"), merged=True,
    ),
    # --- New York ----------------------------------------------------------------------------
    Profile(
        "british_international_ny", "British International School of New York",
        "https://bis-ny.org/about/faculty-and-staff/", "div.elementor-author-box__text",
        dict(name=every(".elementor-author-box__name"), job_title=one(".elementor-author-box__bio p")),
    ),
    Profile(
        "clarke_schools_ny", "Clarke Schools for Hearing and Speech in New York",
        "https://www.clarkeschools.org/about-us/board-of-trustees/", "div.card-body.text-center",
        dict(name=every(".pix-member-name"), job_title=every(".pix-member-title")),
    ),
    Profile(
        "cristo_rey_ny", "Cristo Rey New York High School",
        "https://www.cristoreyny.org/faculty-and-staff", "div.wixui-box",
        dict(name=either(every("h6 span"), every("h3 span")), job_title=one("p"), email=every(MAIL)),
        keep=("all_of", "name", "email"),
    ),
    Profile(
        "easterseals_ny", "Easterseals New York", "https://ny.easterseals.com/about-us/people",
        "div.card__content",
        dict(name=every("h2.h3 span"), job_title=every(".card__subheading"),
             lookup_key=target("a.h3__link")),
        keep=(), lookup=Lookup(fields=dict(email=_DETAIL_TEXT_MAIL)),
    ),
    Profile(
        "german_international_ny", "German International School New York",
        "https://www.gisny.org/our-school/faculty-staff", f"div{FS}",
        dict(name=every(".fsFullName"), job_title=either(every(".fsTitles"), every(".fsDepartments")),
             email=mail(MAIL, "clean")),
        keep=(), paging=Paging("max_attr", "div.fsElementPagination a[data-page]"),
    ),
    Profile(
        "greater_ny_academy", "Greater New York Academy", "https://www.gnya.org/apps/staff/", "li.staff",
        dict(name=every(".name-position .name"), job_title=every(".user-position"),
             lookup_key=target(".name-position a.name", ("prefix_unless_absolute", "https://www.gnya.org"))),
        keep=(), lookup=Lookup(fields=dict(email=_DETAIL_TEXT_MAIL)),
    ),
    Profile(
        "harbor_school_ny", "New York Harbor School", "https://www.newyorkharborschool.org/directory",
        "[data-mesh-id*='inlineContent-gridContainer'] > div", shape="slots", keep=(),
        blocks=dict(bold="span[style*='font-weight:bold']"),
    ),
    Profile(
        "harrow_ny", "Harrow International School New York",
        "https://www.harrownewyork.com/about-us/faculty", f"div{FS}",
        dict(name=every(".fsFullName"), job_title=every(".fsTitles"),
             email=mail(f".fsEmail {MAIL}", "clean")),
    ),
    Profile(
        "keio_ny", "Keio Academy of New York", "https://www.keio.edu/about-us/faculty-staff-directory",
        f"div{FS}",
        dict(
            name=every(".fsFullName"),
            job_title=either(without_label(".fsTitles", TITLES),
                             without_label(".fsDepartments", DEPARTMENTS)),
            email=mail(f".fsEmail {MAIL}", "clean"),
        ),
        keep=(), paging=Paging("label_div", ".fsPaginationLabel", size="cards"),
    ),
    Profile(
        "marymount_ny", "Marymount School of New York", "https://www.marymountnyc.org/about/our-people",
        "li.member-directory-item",
        dict(name=every("h2.title"), job_title=either(every(".job_title"), every(".categories")),
             email=mail(f".email {MAIL}", "clean")),
        paging=Paging("label_of", "span.page-count", query="?&p="),
    ),
    Profile(
        "new_york_avenue", "New York Avenue School",
        "https://www.acboe.org/site/default.aspx?PageType=14&DomainID=117&PageID=197"
        "&ModuleInstanceID=224&ViewID=606008db-225b-4ad2-8f7b-9ebac54372c1&IsMoreExpandedView=True",
        "div.ui-article",
        dict(
            name=one(".ui-article-description span p", "clean", "before_comma"),
            job_title=one(".ui-article-description span p", "clean", "second_comma_part"),
            email=every(f".ui-article-description span {MAIL}"),
        ),
        keep=(),
    ),
    Profile(
        "new_york_elementary", "New York Elementary School", "https://www.usd497.org/staff", f"div{FS}",
        dict(name=every(".fsFullName"), job_title=every(".fsTitles"), email=mail(MAIL, "clean")), keep=(),
    ),
    Profile(
        "school_finder", "School finder",
        "https://www.niche.com/k12/search/best-schools/?geoip=true", ".card.search-result",
        dict(
            name=(Pick("[data-testid='search-result__title']", inside=(("a.search-result__link", 0),),
                       steps=("trim",)),),
            profile_url=target("a.search-result__link", "trim"),
            lookup_key=target("a.search-result__link", "trim"),
        ),
        keep=("all_of", "name", "profile_url"),
        lookup=Lookup(fields=dict(official_website=(
            Pick("a.profile__website__link", "first", "attr:href", scope="page", steps=("trim",)),))),
        columns=columns("name", ("profileUrl", "profile_url"), ("officialWebsite", "official_website")),
    ),
    Profile(
        "new_york_mills", "New York Mills Elementary School", "https://www.nymills.k12.mn.us/staff",
        "div.cs-card",
        dict(name=every(".cs-item-title"), job_title=one(".cs-subtext"),
             lookup_key=target("a[onclick*='email']", "handler_id", attr="onclick")),
        keep=(),
        lookup=Lookup(
            key=(("query_value", "id"),),
            fields=dict(email=(Checked((Pick("body", scope="page"),), ("if_address",)),)),
        ),
    ),
    # --- Dallas ------------------------------------------------------------------------------
    Profile(
        "coram_deo_dallas", "Coram Deo Academy of Dallas",
        "https://www.coramdeoacademy.org/about/leadership", "a.group",
        dict(name=one("p.font-brand-heading", take="visible"),
             job_title=one(r".lg\:absolute p.font-normal", take="visible")),
    ),
    Profile(
        "dallas_christian_academy", "Dallas Christian Academy",
        "https://dallaschristianacademy.org/about-us/faculty-staff", "section.row.text-center article",
        dict(name=every(".staff-title h3"), job_title=every(".staff-title p"),
             email=target(".staff-img a.email", "joined_address", attr="onclick")),
    ),
    Profile(
        "dallas_christian_school", "Dallas Christian School", "https://www.dallaschristian.com/apps/staff/",
        ".user-info",
        dict(name=every(".name"), job_title=every(".user-position"),
             lookup_key=target(".name", ("prefix", "https://www.dallaschristian.com"))),
        lookup=Lookup(fields=dict(email=(
            Pick(MAIL, "first", "attr:href", scope="page", steps=("strip_mailto",)),))),
    ),
    Profile(
        "fusion_academy_dallas", "Fusion Academy Dallas",
        "https://www.fusionacademy.com/campuses/dallas/meet-our-team/", ".staff-item",
        dict(name=every(".content h3"), job_title=every(".content .teacher-info-1")),
    ),
    Profile(
        "grace_academy_dallas", "Grace Academy of Dallas",
        "https://www.graceacademy.com/apps/pages/index.jsp?uREC_ID=462666&type=d",
        "#trustees div.photo h3",
        dict(name=own("clean", "before_comma"), job_title=own("clean", "after_first_comma")),
        card_where=(("not_blank", None),), keep=(),
    ),
    Profile(
        "jesuit_dallas", "Jesuit College Preparatory School of Dallas",
        "https://www.jesuitdallas.org/about/faculty-staff-directory", FS,
        dict(name=every(".fsFullName"),
             job_title=(Pick(".fsBiography p", "first_value", "first_node"),), email=mail()),
        paging=Paging("last_attr", ".fsLastPageLink", bare_first=True), url_per_page=True,
    ),
    Profile(
        "melcher_dallas_elementary", "Melcher-Dallas Elementary School",
        "https://www.melcher-dallascsd.org/page/board-members", ".html-wrapper p",
        dict(name=every(MAIL), job_title=one("span", ("remove_first", ":"), "clean"),
             email=mail(MAIL, "trim")),
        card_where=(("has", MAIL),),
    ),
    Profile(
        "melcher_dallas_high", "Melcher-Dallas High School", "https://www.melcher-dallascsd.org/staff",
        TEST_ID,
        dict(name=one(".name", "trim", take="visible"), job_title=one(".title", "trim", take="visible"),
             phone=one(".phone", "trim", take="visible"), email=mail(f".email {MAIL}", "trim")),
        paging=Paging("next_link", "li.next a:not(.disabled)", query="?page_no="),
        columns=columns(("school", "school_name"), "name", ("title", "job_title"), "phone", "email"),
    ),
    Profile(
        "pioneer_north_dallas", "Pioneer Technology & Arts Academy North Dallas",
        "https://texas.ptaa.org/north-dallas/staff-directory/", ".staff-card",
        dict(name=every(".staff-name"), job_title=every(".staff-title"),
             email=mail(f".staff-contact {MAIL}")),
    ),
    Profile(
        "texans_can_dallas_north", "Texans Can Academy - Dallas North",
        "https://www.texanscan.org/o/dallas/staff", TEST_ID,
        dict(name=every(".staff-info .name"), job_title=every(".staff-info .title"),
             email=mail(f".staff-info .email {MAIL}")),
        paging=Paging("max_href", ".cms-pagination a", query="?page_no=", bare_first=True),
        url_per_page=True,
    ),
    Profile(
        "texans_can_pleasant_grove", "Texans Can Academy - Dallas Pleasant Grove",
        "https://www.texanscan.org/o/dallas/staff", ".contact-box",
        dict(name=every(".name"), job_title=every(".title"), email=mail(".email a"),
             phone=every(".phone")),
        paging=Paging("max_text", ".cms-pagination a", query="?page_no=", bare_first=True),
        columns=columns("school_name", "url", "name", "job_title", "phone", "email"),
    ),
    Profile(
        "melcher_dallas_high_buttons", "Melcher-Dallas High School",
        "https://www.melcher-dallascsd.org/staff", f"div{TEST_ID}",
        dict(
            name=one(".name", "trim", take="visible"), job_title=one(".title", "trim", take="visible"),
            phone=one(".phone", "trim", take="visible"),
            email=one(".email a, .email button", "if_address", "strip_mailto", "trim",
                      take="attr_or_text:href"),
        ),
        paging=Paging("max_text", "nav.cms-pagination a", query="?page_no="),
        columns=columns("name", ("title", "job_title"), "phone", "email"),
    ),
    Profile(
        "dallas_international", "Dallas International School",
        "https://www.dallasinternationalschool.org/about-us/leadership", FS,
        dict(name=every(".fsFullName a"), job_title=every(".fsTitles"), email=mail(f".fsEmail {MAIL}")),
    ),
    Profile(
        "dallas_lutheran", "Dallas Lutheran School",
        "https://www.dallaslutheranschool.com/about/faculty-staff", FS,
        dict(name=every(".fsFullName a"), job_title=every(".fsTitles"), email=mail(f".fsEmail {MAIL}")),
    ),
    Profile(
        "dallas_school_district", "Dallas School District",
        "https://dallassd.com/about-the-district/school-board/", ".b_members .col-lg-4",
        dict(name=every("h4.font-18", "clean", "holder_of"),
             job_title=every("h4.font-18", "clean", "role_of"), image_url=target("img", attr="src")),
        card_where=(("not_blank", "h4.font-18"),), keep=(),
        columns=columns("school_name", "url", "name", "job_title", ("image", "image_url"), "email"),
    ),
    # --- Miami -------------------------------------------------------------------------------
    Profile(
        "miami_middle", "Miami Middle School",
        "https://www.fortwayneschools.org/about-us/board-of-school-trustees",
        "div.fsElement.fsSingleItem",
        dict(name=every("header h2 strong"), job_title=every("header span.fs_style_1"),
             email=mail(f"footer {MAIL}")),
    ),
    Profile(
        "hamilton_city", "Hamilton City Schools", "https://www.hamiltoncityschools.com/staff-directory1", FS,
        dict(name=every("h3.fsFullName a"), job_title=without_label(".fsTitles", TITLES),
             location=without_label(".fsLocations", LOCATIONS), email=mail(f".fsEmail {MAIL}")),
        paging=Paging("label_div", ".fsPaginationLabel", size=24),
        columns=columns("school_name", "url", "name", ("title", "job_title"), "location", "email"),
    ),
    Profile(
        "little_miami_board", "Little Miami High School",
        "https://www.littlemiamischools.com/page/board-members", ".card-container",
        dict(name=every("strong", "clean", "before_dash"), job_title=every("strong", "clean", "after_dash"),
             email=mail()),
        when_empty="failed", empty_message="No board members detected",
    ),
    Profile(
        "miami_arts_charter", "Miami Arts Charter School", "https://miamiartscharter.net/staff",
        "a[href^='/staff/']", dict(name=every("h3"), job_title=one("p")),
        columns=columns("school_name", "url", "name", ("title", "job_title")),
    ),
    Profile(
        "miami_dade_board", "Miami-Dade School Board", "https://www3.dadeschools.net/SchoolBoard/members",
        "div.card.mx-auto.full-height",
        dict(name=one("h4.text-center"), job_title=every("h5.text-uppercase"), email=mail()),
    ),
    Profile(
        "miami_east", "Miami East High School", "https://www.miamieast.k12.oh.us/staff", TEST_ID,
        dict(name=every(".name"), job_title=every(".title"), email=every(MAIL, "trim")),
        paging=Paging("max_href", "nav ul li a", query="?page_no="),
    ),
    Profile(
        "miami_jr_high", "MIAMI JR HS", "https://miamiwardogs.com/about/leadership-team/",
        ".elementor-widget-heading:has(h3)",
        dict(name=every("h3"), job_title=every(".elementor-widget-text-editor em", scope="parent"),
             email=every(f".elementor-widget-text-editor {MAIL}", scope="parent")),
    ),
    Profile(
        "miami_lakes_k8", "Miami Lakes K-8 Center", "https://mlk8center.org/apps/staff/",
        "#staff a[href*='uREC_ID']",
        dict(name=every("dt"), job_title=every("dd"),
             profile_url=target(None, ("prefix", "https://mlk8center.org"))),
        columns=columns("school_name", "url", "name", "job_title", "email", "profile_url"),
    ),
    Profile(
        "miami_r1", "Miami R-1", "https://www.miamir1.net/faculty--staff.html",
        "td.wsite-multicol-col div.paragraph", shape="text_link", keep=(),
    ),
    Profile(
        "miami_springs_middle", "Miami Springs Middle School",
        "https://miamispringsmiddle.net/faculty-and-staff-directory/", "figcaption.wpzabb-member-caption",
        dict(name=every(".wpzabb-member-name-text"), job_title=every(".wpzabb-member-position"),
             email=mail()),
        keep=(),
    ),
    Profile(
        "muasda", "MUASDA", "https://www.muasda.org/faculty-staff/",
        "div.staff_title h2.elementor-heading-title", dict(name=own()), keep=(),
    ),
    Profile(
        "new_miami_high", "New Miami High School", "https://www.new-miami.k12.oh.us/directory", FS,
        dict(name=every(".fsFullName"), job_title=without_label(".fsTitles", TITLES),
             email=mail(f".fsEmail {MAIL}")),
        paging=Paging("max_attr", ".fsElementPagination a"),
    ),
    Profile(
        "slam_miami", "SLAM Charter High School Miami", "https://www.slammiami.com/apps/staff/",
        "li.staff-categoryStaffMember",
        dict(name=every("dl.staffPhotoWrapperRound dt"), job_title=every("dl.staffPhotoWrapperRound dd"),
             profile_url=target("a", ("prefix", "https://www.slammiami.com"))),
        columns=columns("school_name", "url", "name", "job_title", "email", "profile_url"),
    ),
    Profile(
        "tamim_miami", "Tamim Academy of Miami", "https://www.tamimmiami.org/staff/",
        "div.sc_team_item_info",
        dict(name=every(".sc_team_item_title a"), job_title=every(".sc_team_item_position p"), email=mail()),
        keep=(),
    ),
    Profile(
        "greater_miami_adventist", "Greater Miami Adventist Academy", "https://gma.edu/staff.htm",
        "div.xr_txt.Heading_4.xr_bold",
        dict(name=nth("span", 0), job_title=nth("span", 1), email=mail()), keep=(),
    ),
    Profile(
        "mater_miami_beach", "Mater Academy - Miami Beach",
        "https://www.materbeach.com/apps/staff/departmental.jsp?show=TDE", ".staff-categoryStaffMember",
        dict(name=one("dt", "trim"), job_title=one("dd", "trim"),
             profile_url=target("a", ("resolve", "https://www.materbeach.com/apps/staff/departmental.jsp?show=TDE"))),
        group=".staff-category", group_fields=dict(category=one(".staff-header", "trim")), keep=(),
        columns=columns("category", "name", ("position", "job_title"), ("profileUrl", "profile_url")),
    ),
    Profile(
        "miami_elementary", "Miami Elementary School", "https://www.lsc.k12.in.us/directory1", FS,
        dict(name=every("h3.fsFullName a"), location=every(".fsLocations"), email=mail(f".fsEmail {MAIL}")),
        paging=Paging("label_div", ".fsPaginationLabel", size=12),
        columns=columns("school_name", "url", "name", "location", "email"),
    ),
    # --- Seattle -----------------------------------------------------------------------------
    Profile(
        "white_settlement", "White Settlement Independent School District",
        "https://www.wsisd.com/staff/directory", FS,
        dict(name=every(".fsFullName a", "trim"), job_title=without_label(".fsTitles", TITLES, "trim"),
             email=mail(".fsEmail a")),
        paging=Paging("label_div", ".fsPaginationLabel", size=15, suffix="&", bare_first=True),
        columns=_SCHOOL_TITLE,
    ),
    Profile(
        "bridges_seattle", "Bridges Academy Seattle", "https://bridges.edu/faculty-and-staff/",
        ".elementor-widget-image-box",
        dict(name=one(".elementor-image-box-title", "trim"),
             job_title=one(".elementor-image-box-description", "clean", "drop_quotes", "trim")),
    ),
    Profile(
        "brightmont_seattle", "Brightmont Academy – Seattle",
        "https://www.brightmontacademy.com/about-us/leadership-team", ".photogallery-column",
        dict(name=one(".caption-title", "trim"), job_title=one(".caption-text .rteBlock")),
        keep=("any_of", "name", "job_title"),
    ),
    Profile(
        "cristo_rey_seattle", "Cristo Rey Jesuit Seattle High School",
        "https://www.cristoreyseattle.org/about-us/faculty-staff", FS,
        dict(
            name=every(".fsFullName a", "trim"), job_title=every(".fsTitles", "trim"),
            lookup_key=target(".fsViewProfileLink a", "real_link",
                              ("resolve", "https://www.cristoreyseattle.org/about-us/faculty-staff")),
        ),
        keep=(), lookup=Lookup(fields=dict(email=_DETAIL_HREF_MAIL)),
        paging=Paging("label_div", ".fsPaginationLabel", size="label", suffix="&", bare_first=True),
        columns=_SCHOOL_TITLE,
    ),
    Profile(
        "derech_emunah", "Derech Emunah Seattle Girls High School", "https://derechemunah.com/teachers/",
        ".teachers-item",
        dict(name=every(".teachers-item-info h3", "trim"), job_title=one(".teachers-item-info p", "trim")),
    ),
    Profile(
        "north_seattle_french", "North Seattle French School",
        "https://northseattlefrenchschool.com/faculty-and-staff/", ".awsm-team-item",
        dict(name=every(".awsm-personal-info h3", "trim"), job_title=one(".awsm-personal-info span")),
    ),
    Profile(
        "northwest_montessori", "Northwest Montessori School - West Seattle",
        "https://northwestmontessori.org/about/faculty-and-staff/", ".staff-member",
        dict(
            name=one(".staff-member-info-wrap strong", "drop_quotes", "trim"),
            job_title=every(".staff-member-info-wrap", ("line", 1), "trim", take="without:strong"),
            email=mail(".staff-member-info-wrap .staff-member-email", "trim"),
        ),
    ),
    Profile(
        "seattle_academy", "Seattle Academy", "https://www.seattleacademy.org/about-us/our-leadership",
        ".fsConstituentCustom",
        dict(name=every(".fsFullName a", "trim"), job_title=every("h6", "trim", scope="next:.fsElement"),
             email=mail(MAIL, "trim")),
        keep=(),
    ),
    Profile(
        "seattle_amistad", "Seattle Amistad School", "https://seattleamistadschool.org/admissions",
        ".list-item-content",
        dict(name=one(".list-item-content__title", "trim"),
             job_title=one(".list-item-content__description p", "clean", "drop_quotes", "trim")),
    ),
    Profile("seattle_christian", "Seattle Christian School", _SEA_PREP, FS, _SEA_PREP_FIELDS,
            paging=_PAGE_LINKS),
    Profile(
        "seattle_classical_christian", "Seattle Classical Christian School",
        "https://www.seattleclassicalchristianschool.org/staff", ".sqs-html-content p",
        dict(name=one("strong", "drop_quotes", "trim"), job_title=own(take="without:strong")),
    ),
    Profile(
        "seattle_german_american", "Seattle Area German American School",
        "https://www.sagaschool.org/meet-the-staff", "button",
        dict(name=nth("p", 0, "trim"), job_title=nth("p", 1, "trim")), keep=("longer", "name", 1),
    ),
    Profile(
        "seattle_girls", "Seattle Girls' School", "https://www.seattlegirlsschool.org/about/faculty-and-staff",
        "ul > li.group",
        dict(
            name=(Joined((Pick(".first-name", steps=("drop_nbsp", "trim")),
                          Pick(".last-name", steps=("drop_nbsp", "trim"))), ("trim",)),),
            job_title=every(".job-title"),
        ),
    ),
    Profile(
        "seattle_hill", "Seattle Hill Elementary School", "https://www.sno.wednet.edu/contact-us", FS,
        dict(name=every(".fsFullName a", "trim"), email=mail(MAIL, "trim")), paging=_PAGE_LINKS,
    ),
    Profile(
        "seattle_jewish_community", "Seattle Jewish Community School", "https://www.sjcs.net/aboutus/our-team",
        FS, dict(name=every(".fsFullName a", "trim"), job_title=every(".fsTitles")),
    ),
    Profile("seattle_prep", "Seattle Preparatory School", _SEA_PREP, FS, _SEA_PREP_FIELDS,
            paging=_PAGE_LINKS),
    Profile(
        "seattle_nativity", "Seattle Nativity School", "https://www.seattlenativity.org/our-leadership.html",
        ".wsite-multicol-table tbody tr td",
        dict(name=one(".paragraph font", "trim", take="own"),
             job_title=one(".paragraph em", "drop_quotes", "trim")),
        keep=("any_of", "name", "job_title"),
    ),
    Profile(
        "seattle_public", "Seattle Public Schools", "https://www.seattleschools.org/about/leadership/",
        ".wp-block-column", dict(name=one("h4", "trim"), job_title=one("p", "trim")),
        keep=("any_of", "name", "job_title"),
    ),
    Profile(
        "settles_bridge", "Settles Bridge Elementary School",
        "https://settlesbridge.forsyth.k12.ga.us/our-school/staff-directory", "table tbody tr",
        dict(name=(Joined((Pick("td", 1), Pick("td", 0))),), email=every("a", inside=(("td", 3),))),
        keep=(),
    ),
)

BY_ID = {p.profile_id: p for p in PROFILES}

# The sources of a merge run under their report names, in run order.
MERGE_RUN = tuple(
    zip(
        (p.profile_id for p in PROFILES if p.merged),
        (
            "CPS Leadership", "Chicago Hope Academy", "Chicago Christian",
            "Chicago Jewish Day School", "Chicago Jesuit Academy", "Noble Schools",
            "Chicago Waldorf", "Chicago Commons", "SD170", "HSASW Chicago", "Chicago Park School",
            "Montessori Academy Chicago", "Latin School", "Chicago Collegiate", "Lycee Chicago",
            "D187", "Toddler Town", "Association House", "EFAC Chicago", "German School Chicago",
        ),
        strict=True,
    )
)
