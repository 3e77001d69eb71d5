"""The 42 survey datasets as SurveySpec values (UDF-1: one engine, 42 specs).

Everything below the "fixed values" line is data that must equal the survey
questionnaires for right results: header tags, variable names (exact text,
including typographic apostrophes and trailing dots), sentinels, explode
columns and separators. Decisions on the known defects of the original jobs (SURVEY 2.L):
dead sentinels are declared ``None`` (X5), the two fused statements of D19
are split, 19 labels (X6), loose lookups stay loose where the dataset
used them (X2), GPS speed uses the fixed layout unless noted (X3).
"""

from __future__ import annotations

from dataclasses import replace

from .spec import GRID, QA, Block, Section, SurveySpec, Vector

H2 = ("SubjectNum", "Upload")
H3 = ("SubjectNum", "Upload", "Date")
H6 = ("SubjectNum", "Upload", "VisitStart", "VisitEnd", "ClientDuration", "Date")
H7 = H6 + ("SurveyorName",)
TRIPLE = ("FullVariable", "Text", "TopicAnswer")


def loose(*v: str) -> Block:
    return Block(tuple(v), mode="loose")


def grid_loose(*v: str) -> Block:
    return Block(tuple(v), mode="loose", elements=GRID, question="Text", answer="TopicAnswer")


def rec(v, sentinel, *, grid=False, prefix=False, slice_between=None, elements=None) -> Block:
    el = elements or (GRID if grid else QA)
    return Block(tuple(v), mode="strict", elements=el,
                 question="Text" if grid else "FullVariable",
                 answer="TopicAnswer" if grid else "QuestionAnswer",
                 records=True, sentinel=sentinel, strip_prefix=prefix, slice_between=slice_between)


# ----------------------------------------------------------------- fixed values
SKUS_D02 = ("BUDWEISER 355ML BOTTLE", "CLUB LAGER 330ML BOTTLE", "CLUB 625ML BOTTLE",
            "CLUB DRAUGHT (BUBRA) BOTTLE", "CORONA EXTRA 355ML BOTTLE", "EAGLE LAGER 375ML BOTTLE",
            "EAGLE EXTRA STOUT 375ML BOTTLE", "STELLA ARTOIS 330ML BOTTLE", "CLUB SHANDY 330ML BOTTLE",
            "CLUB SHANDY 500ML BOTTLE", "WILD ROOT 625ML BOTTLE", "BRUTAL FRUIT RUBY APPLE SPRITZER 275ML",
            "ABC LAGER 300ML BOTTLE", "GUINNESS FES 330ML BOTTLE", "GUINNESS SMOOTH 330ML",
            "HEINNEKEN 330ML BOTTLE", "STAR LAGER 330ML BOTTLE", "STAR LAGER 625ML BOTTLE",
            "GULDER 625ML BOTTLE", "ORIJIN 300ML BOTTLE", "ORIJIN 625ML BOTTLE", "ORIJIN 330ML CAN",
            "SMIRNOFF ICE DOUBLE BLACK 300ML BOTTLE", "SMIRNOFF ICE GUARANA VODKA MIX 330ML CAN",
            "SMIRNOFF ICE PINEAPPLE PUNCH 300ML BOTTLE", "SMIRNOFF ICE ORIGINAL (RED) 300ML BOTTLE",
            "FREEDOM BEER 330ML BOTTLE", "FREEDOM BEER 625ML BOTTLE", "HUNTERS GOLD 330ML BOTTLE",
            "SAVANNA DRY 330ML BOTTLE", "DARLING LEMON 330ML BOTTLE", "FAXE EXTRA STRONG 330ML CAN",
            "FAXE EXTRA STRONG 500ML CAN", "KISS WILD STRAWBERRY 500ML CAN", "BEL ICE LEMON 330ML BOTTLE")
METRICS_D02 = ("Visit_Availability", "In_Stock_Status", "No_of_Facings", "Display_Location",
               "Promotion_Active", "Type_of_Promotion", "Promo_Signage", "Delivery_Source",
               "Quantity_Delivered", "Price", "Estimated_Sales", "Pack_Quantity", "Keg_Quantity")

MSD_SKUS = ("CLUB DRAUGHT 500ML", "CLUB 625ML RB", "CLUB 330ML RB", "EAGLE LAGER 375ML",
            "EAGLE STOUT 375ML", "BETA MALT 330ML RG", "BETA MALT 330ML PET", "BRUTAL FRUIT 275ML NRB",
            "SHANDY 500ML RB", "BRUTAL FRUIT 500ML CAN", "BUDWEISER 330ML BOTTLE",
            "CORONA EXTRA 330ML BOTTLE", "STELLA ARTOIS 330ML BOTTLE")

D19_STATEMENTS = ("This brand’s tanks are strong and durable.",
                  "They last a very long time without damage.",
                  "The tanks are good quality for the price.",
                  "They are built to withstand Ghana’s weather conditions.",
                  "The brand offers different sizes to meet my needs.",
                  "The tank materials are safe for storing drinking water.",
                  "The installation process is easy and hassle-free.",
                  "This brand has good warranty and after-sales support.",
                  "The tanks are less likely to leak or crack.",
                  "They have wide availability in shops near me.",
                  "A brand I can trust for my family’s well-being.",
                  "It feels modern and innovative.",
                  "It is a brand that keeps its promises.",
                  "The brand offers great value for money.",
                  "The design of the tank is attractive.",
                  "The brand’s logo and markings make it easy to identify.",
                  "I can identify the brand easily from a distance",
                  "This brand is better than most alternatives.",
                  "Brand I trust")

D23_STATEMENTS = ("You enjoyed watching it a lot", "It’s a bit difficult to understand",
                  "The points made were relevant to you", "The points made were believable",
                  "It made you more likely to consume the brand", "The advert made me love the brand",
                  "You enjoyed watching it a lot.", "It’s a bit difficult to understand.",
                  "The points made were relevant to you.", "The points made were believable.",
                  "It made you more likely to consume the brand.", "The advert made me love the brand.")

D26_GRID = ("Watch TV", "Listen to Radio", "Access Internet/Websites/Social Media platform",
            "Read Newspaper/ Read Magazine", "TV 1", "TV 2", "TV 3", "TV 4", "TV 5", "Radio 1",
            "Radio 2", "Radio 3", "Radio 4", "Radio 5", "Platform 1", "Platform 2", "Platform 3",
            "Platform 4", "Platform 5")

D27_VARS = ("biscuit_tom", "biscuit_awareness", "biscuit_extra_aware", "biscuit_advertising",
            "biscuit_consumed", "biscuit_consumed_months", "biscuit_consumed_days",
            "biscuit_consumed_often", "biscuit_consumed_mcberry", "biscuit_consumed_nutrisnax",
            "biscuit_consumed_perk", "biscuit_consumed_royal", "biscuit_consumed_yum")
D27_EXPLODE = ("biscuit_awareness", "biscuit_extra_aware", "biscuit_advertising", "biscuit_consumed",
               "biscuit_consumed_months", "biscuit_consumed_days", "biscuit_consumed_mcberry",
               "biscuit_consumed_nutrisnax", "biscuit_consumed_perk", "biscuit_consumed_royal",
               "biscuit_consumed_yum")

D29_SKUS = ("NUTRISNAX NUTRI MORN OATS", "NUTRISNAX CHOCO DIGESTIVE", "NUTRISNAX TEA TIME",
            "PERK CHOCO FILLED COOKIES", "PERK COCONUT COOKIES", "PERK CHOCO BUTTER COOKIES",
            "PERK BUTTER COOKIES", "NUTRISNAX NUTRI MORN OATS.", "NUTRISNAX CHOCO DIGESTIVE.",
            "NUTRISNAX TEA TIME.", "PERK CHOCO BUTTER COOKIES.", "PERK BUTTER COOKIES.",
            "PERK CHOCO FILLED COOKIES.", "PERK COCONUT COOKIES.")

D32_VARS = ("tom", "spon", "score_card", "brand_engage_12", "brand_engage_3", "brand_engage_1",
            "brand_engage_7", "current_use", "bike_number", "brand_prefer", "future_brand",
            "brand_prefer_reasons", "brand_prefer_likes", "brand_prefer_dislikes", "previous_bike",
            "previous_bike_brand", "bike_switch_reason", "bike_selection_criteria")
D32_EXPLODE = ("spon", "score_card", "brand_engage_12", "brand_engage_3", "brand_engage_1",
               "brand_engage_7", "future_brand", "brand_prefer_reasons", "brand_prefer_likes",
               "brand_prefer_dislikes", "previous_bike", "bike_selection_criteria")

BIKES = ("Boxer", "Yamaha", "Honda", "TVS", "Apsonic", "Haojue", "Royal / Royal Motors", "Sanya", "Suzuki")

ITEM_VARS = ("outlet_code", "item_category", "item_catid", "item_barcode", "item_name",
             "item_manufacturer", "item_brand", "item_pack_type", "itemcode", "item_weight",
             "item_unit", "item_sales_duration", "item_sales", "item_price", "country_of_origin",
             "item_observation")

SUPPLIERS = ("Open Market/ Marché libre", "Bulk suppliers/ Fournisseurs en vrac",
             "Wholesalers/ Grossisters", "Manufacturers/ Fabricants",
             "Nearby retailers/ Détailants à proximité")

SPECS: tuple[SurveySpec, ...] = (
    # survey group 1: beer retail audit
    SurveySpec("D01", "recruit_profile", H6, (loose(
        "Enumerator_Name", "gps_address", "Visit_Date", "Region", "Store_Name", "Contact",
        "Outlet_Code"),), "profile", gps=("gps_address", "dms_fixed")),
    SurveySpec("D02", "social", H3, (), "sku_profile", sku_metric=(SKUS_D02, METRICS_D02),
               explode_trim="Display_Location", drop_all_null=False),
    # survey group 2: salon census
    SurveySpec("D03", "location", ("SubjectNum", "Date", "Upload"), (loose("Outlet_code", "GPS"),),
               "recruit_location", gps=("GPS", "dms_fixed")),
    SurveySpec("D04", "recruit_profile", H6, (loose(
        "Auditor", "country", "city", "market_choice", "Section", "outlet_name", "Outlet_code",
        "outlet_owner", "Contact", "participation", "time_to_audit"),), "new_recruit_profile"),
    SurveySpec("D05", "supply_source", H3, (loose("Outlet_code", "Source"),), "supply_source"),
    SurveySpec("D06", "extra_category", H3, (loose("Outlet_code", "category_extra"),),
               "recruit_extra_category", explode_untrimmed="category_extra"),
    SurveySpec("D07", "category", H3, (loose("Outlet_code", "Category", "segment_wet", "segment_dry"),),
               "recruit_category", categories=True),
    SurveySpec("D08", "outlet_type", H3, (loose("Outlet_code", "outlet_type", "Salon", "Retail"),),
               "recruit_outlet_type"),
    # survey group 3: malt drinks outlet audit
    SurveySpec("D09", "recruit_profile", H6, (loose(
        "Enumerator_Name", "Region", "Store_Name", "Outlet_Code", "Visit_Date", "Contact",
        "gps_address"),), "recruit_profile", gps=("gps_address", "decimal")),
    SurveySpec("D10", "outlet_describe", H2, (
        Block(("branded_status", "brand_type", "vc_status", "vc_count", "abl_fridge_status",
               "abl_fridge_count"), mode="loose", strip_prefix=True),
        rec(tuple(f"vc_Brand{i}" for i in range(1, 11)), None, grid=True)),
        "outlet_describe", header_pairs=True, explode=(("brand_type",), ",")),
    SurveySpec("D11", "product_availability", H2, (
        rec(tuple(f"{s}_Visit_Availability" for s in MSD_SKUS), "CLUB DRAUGHT 500ML_Visit_Availability",
            prefix=True),), "product_availability", header_pairs=True),
    SurveySpec("D12", "product_price", H2, (
        rec(tuple(f"{s}_Price" for s in MSD_SKUS), "CLUB DRAUGHT 500ML_Price", prefix=True),),
        "product_price", header_pairs=True),
    SurveySpec("D13", "product_status", H2, (
        rec(tuple(f"{s}_In_Stock_Status" for s in MSD_SKUS), "CLUB DRAUGHT 500ML_In_Stock_Status",
            prefix=True),), "product_status", header_pairs=True),
    # survey group 4: water tank brand health
    SurveySpec("D14", "recruit_profile", H6, (loose(
        "surveyor", "gps", "region", "age_range", "gender", "Contact", "employment_status",
        "job_type", "survey_recency"),), "recruit_profile", gps=("gps", "dms_fixed")),
    SurveySpec("D15", "tank_social", H3, (loose(
        "participate", "own_tank", "consider_tank", "segment", "business_type", "tank_purpose",
        "decision_maker", "tank_size", "tank_model"),), "owner_overview",
        explode=(("tank_purpose",), ",")),
    SurveySpec("D16", "media", H3, (
        loose("channel_for_reach", "radio_stations", "tv_stations"),
        rec(("TV", "Radio", "WhatsApp", "Facebook", "TikTok", "YouTube", "Billboards / outdoor ads",
             "Print newspapers"), "TV", grid=True)), "media",
        explode=(("radio_stations", "tv_stations"), ",")),
    SurveySpec("D17", "brand_aware", H3, (
        loose("tom_aware", "extra_aware", "extra_aware_other", "advert_aware", "advert_aware_other",
              "confirm_brand_aware", "other_adverts", "recently_used_brand", "brand_purchase_duration",
              "consider_main_brand", "preferred_brand", "awareness_location", "channel_influencial"),
        rec(("Polytank", "Sintex", "Duraplast", "Mountain", "Polystar"), "Polytank", grid=True,
            elements=TRIPLE, slice_between=("brand_adverts", "other_adverts"))), "brand_awareness",
        drop_all_null=False,
        explode=(("other_adverts", "recently_used_brand", "confirm_brand_aware", "extra_aware",
                  "brand_purchase_duration", "awareness_location"), ",")),
    SurveySpec("D18", "tank_preference", H3, (loose(
        "own_tank", "purchase_point", "overall_best", "overall_best_reason", "reason_for_tank",
        "satisfaction_level", "recommendation_likelihood", "next_brand", "first_choice",
        "first_choice_likelihood"),), "tank_preferences",
        explode=(("reason_for_tank", "purchase_point"), ",")),
    SurveySpec("D19", "brand_impress", H2, (rec(D19_STATEMENTS, D19_STATEMENTS[0], grid=True),),
               "owner_impression", header_pairs=True, drop_all_null=False,
               section=Section("brand_impression", "brand_impression", "overall_best"),
               explode=(("brand_impression",), ",")),
    # survey group 5: water tank retail audit
    SurveySpec("D20", "recruit_profile", H6, (loose(
        "Enumerator_Name", "Region", "Store_Name", "Town", "owner_name", "Outlet_Code", "Channel_Type",
        "survey_end", "Visit_Date", "Contact", "gps_address", "closing_gps"),), "recruit_profile"),
    SurveySpec("D21", "product_sales", H2, (rec(
        ("product_name", "item_name", "Stock", "Price", "Purch_Type", "Doc_Purch", "Oral_Purch",
         "Claimed_Sales", "Delivery_Source", "Exclusivity", "brand_exclusivity"), "Stock",
        prefix=True),), "product_sales", header_pairs=True),
    SurveySpec("D22", "product_details", H2, (rec(
        ("item_category", "item_catid", "product_name", "item_name", "itemcode", "item_brand",
         "item_manufacturer", "item_weight", "item_unit", "item_pack_type", "Orientation",
         "country_of_origin"), "item_category", prefix=True),), "product_details",
        header_pairs=True, not_done=True),
    # survey group 6: biscuit consumer study
    SurveySpec("D23", "advert", H2, (
        loose("first_ad_view", "first_ad_brand", "first_ad_impression", "first_ad_extra_impression",
              "second_ad_view", "second_ad_brand", "second_ad_impression", "second_ad_extra_impression"),
        rec(D23_STATEMENTS, D23_STATEMENTS[0], grid=True)), "advert", header_pairs=True,
        drop_all_null=False, explode=(("first_ad_extra_impression", "second_ad_extra_impression"), ".,")),
    SurveySpec("D24", "recruit_profile", H6, (
        loose("surveyor", "title", "prenom", "surname", "phone_number", "address", "city",
              "respondent_id", "survey_agree", "survey_no", "occupation_conflict", "age", "age_range",
              "gender", "income", "contact_back"),
        rec(("Toothpaste", "Biscuits/ Crackers/ Wafers", "Food Seasoning", "Coffee or Beverages",
             "Drinking Yoghurt", "Name confirm", "Phone confirm"), "Toothpaste", grid=True)), "profile"),
    SurveySpec("D25", "social", H3, (loose(
        "house_items", "house_cook", "house_toilet", "house_water", "education", "residence_area",
        "house_type", "occupation", "total_score", "sec_score"),), "social",
        explode=(("house_items", "house_cook"), ",")),
    SurveySpec("D26", "media", H3, (loose("cable_channels"), rec(D26_GRID, None, grid=True)), "media",
               explode=(("cable_channels",), ",")),
    SurveySpec("D27", "brand_aware", H3, (loose(*D27_VARS),), "brand_awareness",
               drop_all_null=False, explode=(D27_EXPLODE, ",")),
    SurveySpec("D28", "biscuit_overview", H3, (loose(
        "biscuit_freq", "biscuit_purchase", "biscuit_influence", "biscuit_eat_change",
        "biscuit_decrease_reason", "biscuit_satisfy"),), "overview",
        explode=(("biscuit_influence",), ",")),
    SurveySpec("D29", "filter_sku", H2, (rec(D29_SKUS, None, grid=True),), "special_skus",
               header_pairs=True, drop_all_null=False),
    # survey group 7: motorbike consumer study
    SurveySpec("D30", "recruit_profile", H6, (loose(
        "surveyor", "gps_point", "region", "name", "phone_number", "age", "survey_agree", "job_type",
        "market_research_study", "own_motorbike", "consider_bike", "usage_history", "bike_frequency",
        "bike_purpose"),), "recruit_profile", gps=("gps_point", "dms_fixed")),
    SurveySpec("D31", "media", H3, (
        loose("media_source", "tv_channels", "tv_channel_prefer", "radio_stations",
              "radio_station_prefer", "social_media", "social_media_prefer", "social_media_hours"),
        rec(("TV1", "TV2", "TV3", "TV4", "TV5", "Radio1", "Radio2", "Radio3", "Radio4", "Radio5"), "TV1",
            grid=True)), "media",
        explode=(("media_source", "tv_channels", "radio_stations", "social_media"), ",")),
    SurveySpec("D32", "brand_aware", H3, (
        loose(*D32_VARS), rec(tuple(f"Brand{i}" for i in range(1, 11)), None, grid=True)),
        "brand_awareness", drop_all_null=False, explode=(D32_EXPLODE, ",")),
    SurveySpec("D33", "brand_description", H2, (rec(tuple(b + "." for b in BIKES), None, grid=True),),
               "brand_description", header_pairs=True, drop_all_null=False),
    SurveySpec("D34", "brand_association", H2, (
        rec(tuple(b + ".." for b in BIKES) + ("{0}..",), None, grid=True),), "brand_association",
        header_pairs=True, drop_all_null=False),
    SurveySpec("D35", "advert", H3, (loose(
        "brand_advert", "boxer_bike_advert", "boxer_advert_type", "boxer_advert_location",
        "boxer_rating", "boxer_recommend"),), "advert",
        explode=(("brand_advert", "boxer_advert_location"), ",")),
    SurveySpec("D36", "advert_impression", H2, (rec(BIKES + ("{0}",), None, grid=True),),
               "advert_impression", header_pairs=True, drop_all_null=False),
    # survey group 8: bottled water retail audit
    SurveySpec("D37", "recruit_items", H2, (rec(ITEM_VARS, "item_category", prefix=True),),
               "recruitment_items", header_pairs=True, fill_first=("outlet_code",), not_done=True,
               strip_paren=("item_name",), rename={"scan": "item_barcode"}),
    SurveySpec("D38", "recruit_profile", H7, (Block((
        "country_name", "city", "outlet_code", "outlet_name", "outlet_type", "outlet_type_code",
        "owner_name", "outlet_direction", "landmark", "water_stock", "soft_drink_presence",
        "soft_drink_count", "contact", "address", "iterindex", "shop_observation"), mode="loose",
        strip_prefix=True),), "recruitment_profile", gps=("address", "strict"),
        rename={"iterindex": "item_count"}),
    SurveySpec("D39", "supplier_profile", ("SubjectNum", "Upload", "Date", "SurveyorName"), (Block((
        "outlet_code", "country_name", "city", "outlet_name", "outlet_type", "outlet_type_code",
        "owner_name"), mode="loose", strip_prefix=True),), "supplier_profile",
        vector=Vector(SUPPLIERS, "purch_freq", "water_stock")),
    SurveySpec("D40", "old_items", H2, (
        rec(("ITEM_NAME", "ITEM_NO", "BARCODE", "CATEGORY", "CATEGORY_CODE", "MANUFACTURER",
             "BRAND_NAME", "ITEM_CODE", "ITEM_WEIGHT", "ITEM_UNIT", "PACK_TYPE", "SALES", "SALES PRICE"),
            "ITEM_NAME", grid=True),
        rec(("old_current_sales", "old_current_price", "outlet_code"), "old_current_sales", prefix=True)),
        "old_items", header_pairs=True, drop_all_null=False, fill_first=("outlet_code",)),
    SurveySpec("D41", "audit_profile", H7, (
        loose("surveyor", "outlet_name", "outlet_code", "address", "prev_item_count", "item_count"),
        grid_loose("Previous Date", "Country", "City", "Outlet Type Description", "Outlet Type Code",
                   "Name of owner", "Landmark", "Direction")), "audit_capture_profile",
        gps=("address", "strict")),
    SurveySpec("D42", "new_items", H2, (rec(ITEM_VARS, "item_category", prefix=True),),
               "new_items", header_pairs=True, fill_first=("outlet_code",), not_done=True,
               strip_paren=("item_name",), rename={"scan": "item_barcode"}),
)

# Datasets that put records beside one-row parts (JN-2): an interview without
# records keeps its row 1.
ZIPPED = {"D10", "D16", "D17", "D19", "D23", "D24", "D26", "D29", "D31", "D32", "D33", "D34", "D36", "D40"}
SPECS = tuple(replace(s, zip_records=True) if s.id in ZIPPED else s for s in SPECS)

BY_ID = {s.id: s for s in SPECS}
