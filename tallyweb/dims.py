"""Lists and tables that results depend on, in their natural order."""

from __future__ import annotations

# ---- Fixed values ----

#: Query parameters that only track, by exact name (case matters).
TRACKING_PARAMS = tuple(
    """
    msockid cvid ocid form gclid dclid ved ei sxsrf rlz aqs cd cad uact oq pcampaignid sca_esv sca_upv srsltid gad_source gad_campaignid gws_rd msclkid
    fbclid mibextid __tn__ __xts__ __cft__ dti eid comment_tracking video_source rdc rdr twclid ref_src ref_url cn __twitter_impression trk trackingId
    refId lipi trackingTags $deep_link %24deep_link correlation_id share_id rdt _branch_match_id $3p %243p $original_url %24original_url ref_campaign
    ref_source tag ascsubtag smid spIA colid coliid crid sprefix refRID adId _trkparms _trksid _from spm spm_id_from spm-cnt algo_expid algo_pvid gps-id
    ws_ab_test btsid cv af mall_affr yclid _openstat redircnt mkt_tok mc_cid mc_eid mc_tc ml_subscriber ml_subscriber_hash _hsenc _hsmi hsCtaTracking
    hsLang hsformkey vmcid _ga _gl wickedid Echobox tracking_source ceneo_spo srcid trackid trkid epik from_source vd_source share_source share_medium
    share_plat refer_from up_id
    """.split()
)

#: Beginnings of names of parameters that only track.
TRACKING_PREFIXES = tuple(
    """
    utm_ mtm_ itm_ ga_ mc_ ml_ _hs __hs pf_rd_ __mk_ __tn_ __xts__ __cft__ scm- scm_ li_ pk_ hc_ _branch_
    """.split()
)

#: Hosts that are never enriched.
BLOCKED_HOSTS = tuple(
    """
    www.yelp.com m.yelp.com www.tripadvisor.com www.tripadvisor.co.uk www.tripadvisor.co.id www.tripadvisor.de www.tripadvisor.fr www.tripadvisor.com.au
    www.indeed.com de.indeed.com id.indeed.com www.ziprecruiter.com www.simplyhired.com www.glassdoor.com www.glassdoor.co.uk www.glassdoor.de www.bbb.org
    maps.google.com www.yellowpages.com www.whitepages.com rocketreach.co www.linkedin.com www.facebook.com m.facebook.com www.instagram.com twitter.com
    x.com www.tiktok.com www.youtube.com www.pinterest.com www.reddit.com www.quora.com www.researchgate.net pmc.ncbi.nlm.nih.gov journals.sagepub.com
    www.tandfonline.com www.amazon.com www.amazon.de www.amazon.fr www.amazon.co.uk www.amazon.ca www.amazon.com.au www.amazon.it www.amazon.es
    www.amazon.com.mx www.amazon.com.br www.amazon.co.jp www.amazon.in www.amazon.nl www.amazon.com.tr www.amazon.sg www.amazon.ae www.walmart.com
    www.etsy.com www.alibaba.com www.aliexpress.com www.aliexpress.us www.taobao.com www.tmall.com www.ebay.com www.ebay.de www.ebay.co.uk www.ebay.fr
    www.ebay.it www.ebay.es www.idealo.de www.idealo.fr www.idealo.it www.kleinanzeigen.de www.mobile.de www.vinted.com www.vinted.fr www.vinted.de
    www.vinted.it www.vinted.es www.leboncoin.fr www.immobilienscout24.de www.zhihu.com zhuanlan.zhihu.com zhidao.baidu.com jingyan.baidu.com
    www.justanswer.com www.chegg.com stackoverflow.com superuser.com askubuntu.com stackexchange.com math.stackexchange.com answers.microsoft.com
    answers.yahoo.com detail.chiebukuro.yahoo.co.jp chiebukuro.yahoo.co.jp www.tenforums.com www.fxp.co.il www.52pojie.cn www.juraforum.de
    www.motor-talk.de www.radioforen.de www.datev-community.de telekomhilft.telekom.de www.60millions-mag.com web2.cylex.de www.bankier.pl www.cnbc.com
    www.bloomberg.com www.reuters.com www.bbc.com www.nytimes.com www.theguardian.com www.washingtonpost.com www.wsj.com edition.cnn.com www.foxnews.com
    join1440.com tecnobits.com www.adobe.com www.canva.com www.dell.com www.microsoft.com support.microsoft.com support.google.com support.apple.com
    www.apple.com github.com gitlab.com bitbucket.org www.chip.de quillbot.com apkpure.com steamcommunity.com www.booking.com www.airbnb.com
    www.expedia.com www.agoda.com www.kayak.com www.priceline.com www.psychologytoday.com www.drugs.com www.webmd.com www.healthline.com
    www.mayoclinic.org medlineplus.gov insurancetoday.cc goodins.life sexfinder.com www.sexfinder.com friendfinder.com www.friendfinder.com
    bakecaincontrii.com cosenza.bakecaincontrii.com poki.com www.poki.com www.jeuxvideo.com www.mlb.com www.nike.com www.adidas.com www.underarmour.com
    www.onepeloton.com www.lululemon.com www.rei.com www.dickssportinggoods.com www.ikea.com www.imdb.com www.scribd.com www.shutterstock.com
    www.gettyimages.com www.ups.com www.fedex.com www.dhl.com
    """.split()
)

#: Ends of hosts of governments, schools and armies.
PUBLIC_SUFFIXES = tuple(
    """
    .edu .gov .mil .ac.uk .gov.uk .edu.au .gov.au .ac.id .go.id .edu.sg .gov.sg .ac.jp .go.jp .gouv.fr .gov.de .gob.mx .gob.es .ac.cn .gov.cn .edu.cn
    .ac.kr .go.kr
    """.split()
)

#: Beginnings of hosts of forums and help desks.
FORUM_PREFIXES = tuple(
    """
    forum. forums. community. diskuse. discussions. support. help.
    """.split()
)

#: Parts of hosts of forums.
FORUM_INFIXES = tuple(
    """
    .forum. .forums. .community.
    """.split()
)

#: Domains of the first search engine.
GOOGLE_DOMAINS = tuple(
    """
    google.com google.co.id google.co.uk google.co.jp google.com.au google.de google.fr google.es gstatic.com googleapis.com googleusercontent.com
    youtube.com youtu.be accounts.google support.google policies.google maps.google translate.google
    """.split()
)

#: Domains of the second.
BING_DOMAINS = tuple(
    """
    bing.com microsoft.com msn.com live.com
    """.split()
)

#: Domains of the third.
DDG_DOMAINS = tuple(
    """
    duckduckgo.com
    """.split()
)

#: Social and low-yield domains.
EXCLUDED_DOMAINS = tuple(
    """
    facebook.com instagram.com twitter.com x.com linkedin.com tiktok.com pinterest.com snapchat.com reddit.com tumblr.com threads.net vimeo.com
    dailymotion.com trustpilot.com foursquare.com zomato.com wikipedia.org wikimedia.org amazon.com ebay.com alibaba.com apple.com play.google.com
    linktr.ee linkin.bio bit.ly t.co medium.com blogspot.com wordpress.com
    """.split()
)

#: Business directories, kept for their listings.
DIRECTORY_DOMAINS = tuple(
    """
    classpass.com yelp.com yellowpages.com yogaalliance.org tripadvisor.com
    """.split()
)

#: Top-level domains an email may have.
TLDS = tuple(
    """
    com net org info biz io co me tv cc xyz app dev tech site online store shop club pro studio agency design media digital global world life fitness
    health travel hotel yoga gym beauty salon restaurant cafe space today email link work asia rent page services center coach training consulting
    solutions academy education care clinic dental vet events marketing photography wedding group team zone network systems expert guru tips bio eco
    foundation institute international partners ventures holdings limited enterprises management properties fun live news social run one top icu vip mobi
    name ly gg to is id uk au de fr jp kr sg my th ph vn in cn tw hk nz ca us br mx es it nl be ch at pl se no dk fi pt ru ua za ae sa il tr ie cz ro hu
    gr ke tz ug ng gh eg ma et qa kw om bh jo lb ar cl pe ec ve cr pa do gt pr tt jm sk bg lt lv ee si hr rs lu mt cy pk bd lk np mm kh la edu gov mil ac
    """.split()
)

#: Parts of emails to reject.
BLOCKED_EMAIL_PARTS = tuple(
    """
    noreply@ no-reply@ error-tracking
    """.split()
)

#: Email domains to reject.
BLOCKED_EMAIL_DOMAINS = tuple(
    """
    example.com domain.com email.com test.com yoursite.com youremail.com yourdomain.com company.com placeholder.com reddit.com
    """.split()
)

#: Local parts of placeholder emails.
PLACEHOLDER_LOCALS = tuple(
    """
    your enter email test example sample noreply no-reply no_reply donotreply user username name
    """.split()
)

#: Parts of local parts of placeholder emails.
PLACEHOLDER_LOCAL_PARTS = tuple(
    """
    youremail enteryour testemail sampleemail myemail enterhere enteremail
    """.split()
)

#: Domains of placeholder emails.
PLACEHOLDER_DOMAINS = tuple(
    """
    example.com example.org example.net test.com test.org domain.com yourdomain.com mydomain.com email.com addresshere.com sampleemail.com placeholder.com
    fakeemail.com company.com yourcompany.com website.com yourwebsite.com
    """.split()
)

#: Handles that are widgets, not accounts.
SOCIAL_NOISE = tuple(
    """
    share intent sharer login signup oauth dialog widgets platform plugins tr flx hashtag search
    """.split()
)

#: State codes that are not taken for countries.
STATE_CODES = tuple(
    """
    CA NY TX WA OR FL IL MA PA AZ CO NV NJ GA NC VA MI OH IN MN WI MO MD TN SC AL KY LA OK CT UT NM NH VT ME RI DE HI AK ID MT ND SD NE KS WV AR MS IA
    """.split()
)

#: Codes of states and provinces (United States, Australia, Canada, Brazil) that are not taken for a country at an address's end.
REGION_CODES = STATE_CODES + tuple(
    """
    NSW VIC QLD WA SA TAS ACT NT
    ON QC BC MB NB NL NS PE SK YT NU
    SP RJ MG BA RS PR SC PE CE PA GO
    """.split()
)

#: Country names that an address may end in.
ADDRESS_COUNTRIES = (
    "United States", "United Kingdom", "Indonesia", "Australia", "Canada", "Germany", "France", "Singapore", "Malaysia", "Thailand", "Japan", "Brazil", "Mexico", "Spain", "Italy",
    "Netherlands", "Belgium", "Sweden", "Norway", "Denmark", "Finland", "Poland", "Turkey", "India", "China", "Korea", "Vietnam", "Philippines", "New Zealand",
)

#: Patterns of handles by network; group 1.
SOCIAL = {
    "instagram": r"https?://(?:www\.)?instagram\.com/([a-zA-Z0-9._]+)/?",
    "facebook": r"https?://(?:www\.)?facebook\.com/([a-zA-Z0-9._\-]+)/?",
    "twitter": r"https?://(?:www\.)?(?:twitter\.com|x\.com)/([a-zA-Z0-9._]+)/?",
    "linkedin": r"https?://(?:www\.)?linkedin\.com/(?:company|in)/([a-zA-Z0-9._\-]+)/?",
    "tiktok": r"https?://(?:www\.)?tiktok\.com/@([a-zA-Z0-9._]+)/?",
    "youtube": r"https?://(?:www\.)?youtube\.com/(?:c/|channel/|user/|@)([a-zA-Z0-9._\-]+)/?",
    "telegram": r"https?://(?:www\.)?t(?:elegram)?\.me/([a-zA-Z0-9_]+)/?",
}

#: Pattern of a number to write to; group 1.
WHATSAPP = r"(?:wa\.me|api\.whatsapp\.com/send\?phone=)[/=]*(\+?\d{10,15})"

#: Types of structured data that name no category.
GENERIC_TYPES = ("WebSite", "WebPage", "BreadcrumbList", "ItemList", "SearchAction", "ReadAction", "ImageObject")

#: Country names to ISO 3166-1 alpha-2.
COUNTRY_NAMES = {
    "united states": "US",
    "united states of america": "US",
    "usa": "US",
    "u.s.a.": "US",
    "u.s.": "US",
    "america": "US",
    "united kingdom": "GB",
    "uk": "GB",
    "great britain": "GB",
    "england": "GB",
    "scotland": "GB",
    "wales": "GB",
    "indonesia": "ID",
    "republic of indonesia": "ID",
    "australia": "AU",
    "canada": "CA",
    "germany": "DE",
    "deutschland": "DE",
    "france": "FR",
    "spain": "ES",
    "españa": "ES",
    "italy": "IT",
    "italia": "IT",
    "netherlands": "NL",
    "nederland": "NL",
    "holland": "NL",
    "singapore": "SG",
    "malaysia": "MY",
    "thailand": "TH",
    "japan": "JP",
    "korea": "KR",
    "south korea": "KR",
    "republic of korea": "KR",
    "china": "CN",
    "people's republic of china": "CN",
    "vietnam": "VN",
    "viet nam": "VN",
    "philippines": "PH",
    "india": "IN",
    "brazil": "BR",
    "brasil": "BR",
    "mexico": "MX",
    "méxico": "MX",
    "new zealand": "NZ",
    "switzerland": "CH",
    "belgium": "BE",
    "sweden": "SE",
    "norway": "NO",
    "denmark": "DK",
    "finland": "FI",
    "poland": "PL",
    "turkey": "TR",
    "türkiye": "TR",
    "united arab emirates": "AE",
    "uae": "AE",
    "saudi arabia": "SA",
    "south africa": "ZA",
}

#: Country: search locale (gl, hl, cc, language, region).
LOCALES = {
    "Indonesia": ("id", "id", "id", "id", "id-id"),
    "Thailand": ("th", "th", "th", "th", "th-th"),
    "Vietnam": ("vn", "vi", "vn", "vi", "vn-vi"),
    "Philippines": ("ph", "tl", "ph", "en", "ph-en"),
    "Malaysia": ("my", "ms", "my", "ms", "my-ms"),
    "Singapore": ("sg", "en", "sg", "en", "sg-en"),
    "Cambodia": ("kh", "km", "kh", "en", "kh-en"),
    "Myanmar": ("mm", "my", "mm", "en", "mm-en"),
    "United States": ("us", "en", "us", "en", "us-en"),
    "Canada": ("ca", "en", "ca", "en", "ca-en"),
    "Australia": ("au", "en", "au", "en", "au-en"),
    "New Zealand": ("nz", "en", "nz", "en", "nz-en"),
    "United Kingdom": ("uk", "en", "gb", "en", "uk-en"),
    "Ireland": ("ie", "en", "ie", "en", "ie-en"),
    "Germany": ("de", "de", "de", "de", "de-de"),
    "Austria": ("at", "de", "at", "de", "at-de"),
    "Switzerland": ("ch", "de", "ch", "de", "ch-de"),
    "France": ("fr", "fr", "fr", "fr", "fr-fr"),
    "Spain": ("es", "es", "es", "es", "es-es"),
    "Netherlands": ("nl", "nl", "nl", "nl", "nl-nl"),
    "Belgium": ("be", "nl", "be", "nl", "be-nl"),
    "Italy": ("it", "it", "it", "it", "it-it"),
    "Portugal": ("pt", "pt", "pt", "pt", "pt-pt"),
    "Sweden": ("se", "sv", "se", "sv", "se-sv"),
    "Denmark": ("dk", "da", "dk", "da", "dk-da"),
    "Norway": ("no", "no", "no", "nb", "no-no"),
    "Finland": ("fi", "fi", "fi", "fi", "fi-fi"),
    "Poland": ("pl", "pl", "pl", "pl", "pl-pl"),
    "Czech Republic": ("cz", "cs", "cz", "cs", "cz-cs"),
    "Hungary": ("hu", "hu", "hu", "hu", "hu-hu"),
    "Romania": ("ro", "ro", "ro", "ro", "ro-ro"),
    "Croatia": ("hr", "hr", "hr", "hr", "hr-hr"),
    "Greece": ("gr", "el", "gr", "el", "gr-el"),
    "Turkey": ("tr", "tr", "tr", "tr", "tr-tr"),
    "India": ("in", "en", "in", "en", "in-en"),
    "Sri Lanka": ("lk", "si", "lk", "en", "lk-en"),
    "Nepal": ("np", "ne", "np", "en", "np-en"),
    "UAE": ("ae", "ar", "ae", "ar", "ae-ar"),
    "Qatar": ("qa", "ar", "qa", "ar", "qa-ar"),
    "Saudi Arabia": ("sa", "ar", "sa", "ar", "sa-ar"),
    "Bahrain": ("bh", "ar", "bh", "ar", "bh-ar"),
    "Japan": ("jp", "ja", "jp", "ja", "jp-jp"),
    "South Korea": ("kr", "ko", "kr", "ko", "kr-ko"),
    "Taiwan": ("tw", "zh-TW", "tw", "zh-Hant", "tw-tzh"),
    "Hong Kong": ("hk", "zh-TW", "hk", "zh-Hant", "hk-tzh"),
    "South Africa": ("za", "en", "za", "en", "za-en"),
    "Kenya": ("ke", "en", "ke", "en", "ke-en"),
    "Nigeria": ("ng", "en", "ng", "en", "ng-en"),
    "Morocco": ("ma", "fr", "ma", "fr", "ma-fr"),
    "Egypt": ("eg", "ar", "eg", "ar", "eg-ar"),
    "Mexico": ("mx", "es", "mx", "es", "mx-es"),
    "Brazil": ("br", "pt-BR", "br", "pt-BR", "br-pt"),
    "Colombia": ("co", "es", "co", "es", "co-es"),
    "Argentina": ("ar", "es", "ar", "es", "ar-es"),
    "Chile": ("cl", "es", "cl", "es", "cl-es"),
    "Peru": ("pe", "es", "pe", "es", "pe-es"),
    "Costa Rica": ("cr", "es", "cr", "es", "cr-es"),
    "Panama": ("pa", "es", "pa", "es", "pa-es"),
}

#: Alpha-3 codes that are known.
ALPHA3 = {"USA": "US", "GBR": "GB", "IDN": "ID"}

#: Errors that no retry mends.
PERMANENT_ERRORS = ("HTTP 404", "HTTP 410", "HTTP 451", "certificate", "x509", "no such host", "server misbehaving")

#: Marks of pages that block robots, by engine.
BLOCK_MARKS = {
    "google": ("captcha", "unusual traffic", "not a robot", "recaptcha", "/sorry/", "detected unusual traffic", "systems have detected"),
    "bing": ("turing", "/captcha", "class=\"captcha", "captcha_header"),
    "duckduckgo": ("anomaly-modal", "anomaly_modal"),
}

#: Pages that may hold contacts.
CONTACT_PATHS = ("/contact", "/contact-us", "/about", "/about-us")

#: More of them, for the run without a store.
MORE_CONTACT_PATHS = ("/contact", "/contact-us", "/kontakt", "/about", "/about-us", "/hubungi-kami", "/team", "/impressum", "/contact.html")

#: Errors of jobs that stay dead.
FINAL_ERRORS = ("HTTP 403%", "HTTP 404%", "HTTP 410%", "HTTP 451%", "%certificate%", "%x509%", "%no such host%", "%server misbehaving%", "permanently dead%")

#: Business keywords.
NICHES = (
    "yoga", "yoga studio", "yoga class", "yoga school", "yoga center", "yoga shala", "yoga ashram", "yoga teacher training", "yoga ttc", "yoga retreat", "yogafx", "yoga academy", "online yoga",
    "bikram yoga", "hot yoga", "vinyasa yoga", "ashtanga yoga", "yin yoga", "aerial yoga", "prenatal yoga", "postnatal yoga", "power yoga", "kundalini yoga", "iyengar yoga", "hatha yoga",
    "restorative yoga", "jivamukti yoga", "rocket yoga", "acro yoga", "rope yoga", "kids yoga", "chair yoga",
    "pilates", "pilates studio", "pilates class", "reformer pilates", "mat pilates", "clinical pilates", "pilates teacher training",
    "gym", "fitness center", "fitness studio", "fitness club", "boutique gym", "crossfit", "crossfit box", "functional fitness", "bootcamp", "hiit class", "barre studio", "spin studio", "boxing gym",
    "wellness", "wellness center", "wellness studio", "wellness retreat", "wellness resort", "wellness clinic", "healing", "healing center", "healing retreat", "holistic wellness", "holistic healing",
    "holistic center", "mindfulness center", "mindfulness retreat", "meditation", "meditation center", "meditation retreat", "breathwork", "breathwork studio", "sound healing", "sound bath", "reiki healing",
    "energy healing", "ayurveda", "ayurvedic center", "ayurvedic retreat", "day spa", "wellness spa", "health spa", "thermal spa", "thai massage", "therapeutic massage",
)

#: Keywords of single practitioners.
PERSONAL_NICHES = (
    "yoga instructor", "yoga teacher", "yoga therapist", "yoga trainer", "yoga coach", "yoga guru", "prenatal yoga teacher", "postnatal yoga teacher", "kids yoga teacher", "aerial yoga instructor",
    "hot yoga instructor", "vinyasa yoga teacher", "ashtanga yoga teacher", "kundalini yoga teacher", "iyengar yoga teacher", "pilates instructor", "pilates teacher", "reformer pilates instructor",
    "clinical pilates instructor", "personal trainer", "fitness coach", "fitness instructor", "fitness trainer", "online personal trainer", "crossfit coach", "strength coach", "conditioning coach",
    "functional trainer", "bootcamp instructor", "hiit instructor", "barre instructor", "spin instructor", "boxing trainer", "wellness coach", "wellness practitioner", "wellness consultant",
    "wellness therapist", "health coach", "holistic health coach", "holistic wellness coach", "holistic practitioner", "meditation teacher", "meditation guide", "meditation instructor", "mindfulness teacher",
    "mindfulness coach", "breathwork facilitator", "breathwork coach", "reiki practitioner", "reiki healer", "reiki master", "energy healer", "energy worker", "crystal healer", "sound healer", "sound therapist",
    "ayurvedic practitioner", "ayurvedic therapist", "ayurvedic doctor", "ayurvedic consultant",
)

#: Searches within sites, of a niche and a city.
SITE_TEMPLATES = (
    "site:yogaalliance.org %s %s", "site:classpass.com %s %s", "site:mindbodyonline.com %s %s", "site:instagram.com %s %s email", "site:instagram.com %s %s contact", 'site:instagram.com %s %s "@gmail.com"',
    "site:facebook.com %s %s contact", "site:facebook.com %s %s email", "site:linkedin.com/in %s %s", "site:yelp.com/biz %s %s", "site:eventbrite.com %s %s", "site:punchpass.com %s %s", "site:momence.com %s %s",
    "site:wellnessliving.com %s %s", "site:yogatrail.com %s %s", "site:bookyogaretreats.com %s %s", "site:bookyogateachertraining.com %s %s",
)

#: Result pages by engine.
ENGINE_PAGES = {"google": 1, "bing": 5, "duckduckgo": 3}

#: Targets of the email-provider report.
PROVIDERS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com")
