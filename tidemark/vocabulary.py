"""Default term lists.

Every operator takes its lists as parameters; these are the defaults. The
lists are fixed values: results depend on the exact entries and, for the
taxonomy and the search phrases, on their order.
"""

from __future__ import annotations


def _terms(text: str) -> tuple[str, ...]:
    return tuple(term.strip() for term in text.replace("\n", " ").split(",") if term.strip())


# ---------------------------------------------------------------- fixed values
DEFAULT_TOPIC = "cost_of_living"

TAXONOMY: dict[str, tuple[str, ...]] = {
    "housing": _terms("""
        rent, rent increase, rent hike, rental, renting, rental crisis, rents, renter, renters,
        renter rights, landlord, lease, tenant, tenant rights, eviction, evictions,
        no grounds eviction, no grounds evictions, no-grounds eviction, no-grounds evictions,
        mortgage, mortgage stress, interest rate, interest rates, rba, housing,
        housing affordability, housing supply, apartment, house price, house prices"""),
    "groceries": _terms("""
        grocery, groceries, grocery prices, supermarket, coles, woolworths, woolies, aldi, food,
        food prices, price gouging, milk, bread"""),
    "fuel": _terms("petrol, petrol prices, fuel, fuel prices, diesel, servo, bowser"),
    "energy": _terms("""
        electricity, electricity bill, electricity prices, energy, power, power bill, power prices,
        gas bill, energy bill, bill shock, rebate, energy rebate, utility, utilities"""),
    "transport": _terms("""
        myki, opal, public transport, train fare, bus fare, tram fare, train, tram, bus, commute,
        transport, fare, fares, toll, parking"""),
    "eating_out": _terms("coffee, cafe, takeaway, ubereats, doordash, restaurant, brunch"),
    "healthcare": _terms("""
        gp, doctor, dentist, medicare, pharmacy, medicine, health insurance, gap fee,
        bulk billing"""),
    "home_goods": _terms("""
        furniture, appliance, appliances, fridge, washing machine, household items,
        household goods, home goods, sofa, mattress, whitegoods, microwave, dishwasher, dryer,
        vacuum, bed frame"""),
    "inflation": _terms("""
        inflation, cpi, consumer price index, prices, price rise, price rises, price increase,
        price increases, cost of living, cost-of-living, living costs, rising prices,
        rising costs"""),
    "wages": _terms("wage, wages, wage growth, salary, pay rise, income, real wages, minimum wage"),
    "debt": _terms("""
        hecs, hecs debt, help debt, student debt, credit card, household debt, loan repayment,
        repayments"""),
    "education": _terms("""
        school fees, tuition fees, education costs, uni fees, university fees, childcare fees,
        textbook costs, school costs, education, school uniforms, stationery costs, daycare fees,
        school supplies"""),
}

TOPIC_LABELS: dict[str, str] = {
    "housing": "Housing / Rent",
    "groceries": "Groceries",
    "fuel": "Fuel",
    "energy": "Electricity / Utilities",
    "transport": "Transport",
    "eating_out": "Eating Out",
    "healthcare": "Healthcare",
    "home_goods": "Home Goods",
    "education": "Education",
    "inflation": "Inflation",
    "wages": "Wages",
    "debt": "Debt",
    "cost_of_living": "Cost of Living",
}

# topic -> official price items, best first
OFFICIAL_ITEMS: dict[str, tuple[str, ...]] = {
    "housing": ("Rents", "New dwelling purchase by owner-occupiers", "Housing"),
    "groceries": (
        "Food and non-alcoholic beverages",
        "Bread and cereal products",
        "Dairy and related products",
        "Fruit and vegetables",
    ),
    "fuel": ("Automotive fuel", "Transport"),
    "energy": ("Electricity", "Gas and other household fuels"),
    "transport": ("Transport", "Urban transport fares", "Automotive fuel"),
    "eating_out": ("Meals out and take away foods", "Food and non-alcoholic beverages"),
    "healthcare": ("Medical and hospital services", "Pharmaceutical products", "Health"),
    "home_goods": ("Furniture", "Furniture and furnishings", "Household equipment and services"),
    "education": ("Education", "Child care", "Tertiary education", "Secondary education"),
    "inflation": ("All groups CPI",),
    "wages": ("All groups CPI",),
    "debt": ("All groups CPI",),
    "cost_of_living": ("All groups CPI",),
}

# query seeds that carry no topic of their own
GENERIC_SEEDS = _terms("cost of living, cost-of-living, living costs, rising costs, rising prices")

LOCAL_CONTEXT_TERMS = _terms("""
    australia, australian, australians, aussie, aus, auspol, melbourne, sydney, brisbane, perth,
    adelaide, canberra, tasmania, hobart, darwin, gold coast, geelong, nsw, vic, qld, wa, sa, myki,
    opal, medicare, woolworths, woolies, coles, aldi australia, centrelink""")

COMPLAINT_TERMS = _terms("""
    expensive, too expensive, cant afford, can't afford, afford, affordability, costs too much,
    cost too much, costing more, costing too much, more expensive, getting expensive,
    getting pricier, so expensive, so pricey, pricey, overpriced, price hike, prices up,
    price rise, price rises, price increase, price increases, gone up, goes up, going up,
    keep going up, keeps going up, everything is going up, increase, increased, raising, rising,
    outrageous, ridiculous, crazy prices, out of control, through the roof,
    gone through the roof, struggling, struggle, struggling with bills, struggling to pay, broke,
    cost of living, bill shock, tight budget, budget pressure, budget squeeze, rent hike,
    rent increase, price gouging, stress, cost pressure, financial pressure, hurting, hurts,
    squeezed, squeeze, unaffordable, hard to pay, hard to keep up, getting harder,
    living is getting harder, harder to afford, breaking the bank, stretching the budget,
    too much""")

# the relevance score counts two more words than the relevance filter
SCORING_COMPLAINT_TERMS = COMPLAINT_TERMS + ("budget", "pressure")

PROMOTION_TERMS = _terms("""
    register, join now, follow link, tickets, sale, promotion, special offer, buy now,
    subscribe""")

COVERAGE_TERMS = _terms("""
    cost of living, cost-of-living, affordability, unaffordable, inflation, prices, price rise,
    price rises, price increase, price increases, bill shock, housing affordability,
    housing supply, mortgage stress, rental crisis, rent increase, household budgets,
    household budget, living costs, rising costs, rising prices, crisis, squeeze, squeezed""")

FOREIGN_TERMS = _terms("""
    england, britain, uk, united kingdom, europe, european, america, american, usa, us consumer,
    republican, republicans, gop, trump, philippines, sara duterte, social security, new york,
    canada, ireland, bournemouth, bristol, bay area""")

NOISE_TEXTS = _terms("available in the ios app store, rent free in my head")

BLOCKED_TERMS: dict[str, tuple[str, ...]] = {
    "housing": _terms("west end, musical, broadway, show"),
    "fuel": _terms("war profits, renewables, solar, geopolitics"),
    "home_goods": _terms("interior design, home decor, styling tips, gift guide, sale now on"),
    "education": _terms("""
        education policy, curriculum reform, school ranking, teaching strategy, student visa"""),
}

# topics for which a keyword alone is not enough
STRICT_TOPICS = _terms("""
    housing, groceries, fuel, energy, transport, eating_out, healthcare, home_goods, education""")

DEFAULT_UNCLEAN_FLAGS = ("metadata_heavy", "weak_australia_context")

STOPWORDS = _terms("""
    about, after, again, against, also, and, are, australia, australian, been, but, can, could,
    for, from, has, have, into, its, just, more, not, now, our, out, over, price, prices, said,
    than, that, the, their, there, they, this, through, with, would, year""")

# ---- news archives
NEWS_TEXT_POSITIONS = (3, 4, 7, 8, 9, 10, 11, 12, 13, 14, 23, 24, 26)

NEWS_COST_TERMS = _terms("""
    cost of living, cost-of-living, affordability, afford, unaffordable, inflation, expensive,
    too expensive, more expensive, prices, price, price rise, price rises, price increase,
    price increases, price hike, price hikes, bill shock, living costs, rising costs,
    rising prices, cost pressure, financial pressure, budget pressure, budget squeeze,
    struggling, struggle, hard to pay, harder to afford, rental crisis, rent increase, rent hike,
    mortgage stress""")

NEWS_LOCAL_TERMS = _terms("""
    australia, australian, melbourne, sydney, brisbane, perth, adelaide, canberra, tasmania,
    hobart, darwin, nsw, vic, qld, wa, myki, opal, medicare, coles, woolworths, woolies,
    centrelink""")

NEWS_CATEGORY_TERMS: dict[str, tuple[str, ...]] = {
    "housing": _terms("rent, rental, renting, landlord, housing, tenant, renters, mortgage"),
    "groceries": _terms("groceries, grocery, supermarket, coles, woolworths, woolies, aldi, food"),
    "fuel": _terms("petrol, fuel, diesel, servo, bowser"),
    "energy": _terms("electricity, power bill, energy bill, gas bill, utilities, power"),
    "eating_out": _terms("coffee, cafe, takeaway, ubereats, doordash, restaurant, brunch"),
    "transport": _terms("""
        myki, opal, public transport, train fare, bus fare, tram fare, toll, parking"""),
    "healthcare": _terms("""
        gp, doctor, dentist, medicare, pharmacy, medicine, health insurance, bulk billing"""),
    "home_goods": _terms("""
        furniture, appliance, fridge, washing machine, sofa, mattress, whitegoods"""),
    "education": _terms("""
        school fees, tuition fees, education costs, uni fees, childcare fees, hecs,
        student debt"""),
}

NEWS_SEARCH_PHRASES: dict[str, tuple[str, ...]] = {
    "housing": _terms("""
        rent increase australia, rent hike australia, rental crisis australia,
        housing affordability australia, cant afford rent australia,
        rent too expensive australia, rent melbourne, rent sydney,
        landlord raised rent australia, tenant rent increase australia"""),
    "groceries": _terms("""
        grocery bill australia, groceries too expensive australia, supermarket prices australia,
        coles prices australia, woolworths prices australia, food prices australia,
        grocery prices melbourne, grocery prices sydney"""),
    "fuel": _terms("""
        petrol prices australia, fuel prices australia, petrol too expensive australia,
        fuel cost australia, petrol melbourne, petrol sydney, diesel prices australia,
        servo prices australia"""),
    "energy": _terms("""
        power bill australia, electricity bill australia, energy bill australia,
        gas bill australia, electricity prices australia, power prices australia,
        bill shock electricity australia"""),
    "eating_out": _terms("""
        coffee price australia, coffee too expensive melbourne, takeaway expensive australia,
        ubereats expensive australia, doordash expensive australia,
        restaurant prices australia, brunch expensive melbourne"""),
    "transport": _terms("""
        public transport cost australia, myki fare melbourne, opal fare sydney,
        train fare australia, bus fare australia, tram fare melbourne,
        toll road cost australia, parking cost australia"""),
    "healthcare": _terms("""
        gp cost australia, doctor cost australia, dentist expensive australia,
        medicare gap australia, medicine cost australia, pharmacy cost australia,
        health insurance expensive australia, gp gap fee australia"""),
    "home_goods": _terms("""
        furniture prices australia, appliance prices australia, fridge expensive australia,
        washing machine expensive australia, household items expensive australia,
        home goods prices australia, mattress expensive australia, sofa expensive australia,
        whitegoods prices australia"""),
    "education": _terms("""
        school fees australia, tuition fees australia, education costs australia,
        uni fees australia, university fees australia, childcare fees australia,
        textbook costs australia, school costs australia, hecs debt australia,
        student debt australia, childcare too expensive australia,
        uni too expensive australia"""),
}

# ---- social sources
SOCIAL_LOCAL_TERMS: dict[str, tuple[str, ...]] = {
    "bluesky": _terms("""
        australia, australian, aussie, sydney, melbourne, brisbane, perth, adelaide, canberra,
        hobart, darwin, nsw, vic, qld, wa, tasmania, coles, woolworths, woolies, aldi, myki, opal,
        medicare"""),
}
SOCIAL_LOCAL_TERMS["mastodon"] = SOCIAL_LOCAL_TERMS["bluesky"] + ("mastodon.au", "aus.social")

# ---- sentiment: constants of the published rule set (Hutto & Gilbert, ICWSM 2014)
SENTIMENT_ALPHA = 15.0
BOOST = 0.293
NEGATION_FACTOR = -0.74
BOOSTER_DAMPING = (1.0, 0.95, 0.9)
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_LIMIT = 0.292, 4
QUESTION_STEP, QUESTION_LIMIT, QUESTION_MAX = 0.18, 3, 0.96
LABEL_CUT = 0.05
NEVER_SO_NEAR, NEVER_SO_FAR = 1.5, 1.25  # "never so/this" two and three words before
INTENSE_AFTER_NEVER = ("so", "this")
ALTERNATIVES = ("or", "nor")  # "no x or y"
LEAST_EXEMPT = ("at", "very")  # "at least", "very least"
DAMPING_PHRASES = ("kind of", "sort of", "just enough")
IDIOMS: dict[str, float] = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0,
    "cut the mustard": 2.0, "kiss of death": -1.5, "hand to mouth": -2.0, "beating heart": 3.1, "broken heart": -2.9,
}

BOOSTERS_UP = _terms("""
    absolutely, amazingly, awfully, completely, considerably, decidedly, deeply, enormously,
    entirely, especially, exceptionally, extremely, fabulously, fully, greatly, highly, hugely,
    incredibly, intensely, majorly, more, most, particularly, purely, quite, really, remarkably,
    so, substantially, thoroughly, totally, tremendously, unbelievably, unusually, utterly, very""")
BOOSTERS_DOWN = _terms("""
    almost, barely, hardly, less, little, marginally, occasionally, partly, scarcely, slightly,
    somewhat""")
NEGATIONS = _terms("""
    aint, arent, cannot, cant, couldnt, darent, didnt, doesnt, dont, hadnt, hasnt, havent, isnt,
    mightnt, mustnt, neither, neednt, never, none, nope, nor, not, nothing, nowhere, oughtnt,
    shant, shouldnt, wasnt, werent, without, wont, wouldnt, rarely, seldom, despite""")

# small starter lexicon; production runs pass a full (token, valence) table
STARTER_LEXICON: dict[str, float] = {
    "good": 1.9, "great": 3.1, "best": 3.2, "better": 1.9, "love": 3.2, "happy": 2.7, "nice": 1.8,
    "help": 1.7, "helpful": 1.8, "hope": 1.9, "relief": 2.1, "improve": 1.9, "improved": 2.1,
    "fair": 1.3, "win": 2.8, "free": 2.3, "save": 2.2, "support": 1.7, "thanks": 1.9, "glad": 2.0,
    "bad": -2.5, "worse": -2.1, "worst": -3.1, "terrible": -2.1, "awful": -2.0, "hate": -2.7,
    "crisis": -3.1, "stress": -1.8, "struggling": -1.8, "struggle": -1.3, "ridiculous": -1.5,
    "outrageous": -2.0, "pressure": -1.2, "hurting": -1.7, "hurts": -2.1, "pain": -2.3,
    "poor": -2.1, "angry": -2.3, "sad": -2.1, "fear": -2.2, "worried": -1.2, "broke": -1.8,
    "debt": -1.5, "shock": -1.6, "gouging": -1.9, "hard": -0.4, "problem": -1.7, "unfair": -2.1,
    "worthless": -1.9, "fail": -2.5, "lost": -1.3, "lose": -1.7, "pay": -0.4, "cut": -1.1,
}
# ------------------------------------------------------------ end fixed values
