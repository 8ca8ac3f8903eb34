"""Layouts, filters and metric rules of the five public-sector domains.

Only fixed values live here: code and name lists, file positions, column names
and rule tables. They must equal the published file layouts and metric names for
results to be right.
"""

from __future__ import annotations

from wardmetrics.operators.filters import anniversary, keep_values, year_range
from wardmetrics.operators.reshape import unpivot_years
from wardmetrics.operators.spatial import drop_layer_attributes, grid_to_lonlat, points_in_polygons
from wardmetrics.sources.raw import layout

# ---- Fixed values: areas ---------------------------------------------------

# 33 borough codes, and the code of the whole country.
BOROUGH_CODES = [f"E090000{n:02d}" for n in range(1, 34)]
COUNTRY_CODE = "K02000001"
AREA_CODES = [COUNTRY_CODE, *BOROUGH_CODES]

BOROUGH_NAMES = [
    "City of London", "Barking and Dagenham", "Barnet", "Bexley", "Brent",
    "Bromley", "Camden", "Croydon", "Ealing", "Enfield",
    "Greenwich", "Hackney", "Hammersmith and Fulham", "Haringey", "Harrow",
    "Havering", "Hillingdon", "Hounslow", "Islington", "Kensington and Chelsea",
    "Kingston upon Thames", "Lambeth", "Lewisham", "Merton", "Newham",
    "Redbridge", "Richmond upon Thames", "Southwark", "Sutton", "Tower Hamlets",
    "Waltham Forest", "Wandsworth", "Westminster",
]

# ---- Fixed values: event categories ----------------------------------------

CRIME_GROUPS = {
    "violent-crime": "Violent & Serious Crime",
    "possession-of-weapons": "Violent & Serious Crime",
    "robbery": "Violent & Serious Crime",
    "burglary": "Property & Theft Crime",
    "vehicle-crime": "Property & Theft Crime",
    "bicycle-theft": "Property & Theft Crime",
    "shoplifting": "Property & Theft Crime",
    "theft-from-the-person": "Property & Theft Crime",
    "other-theft": "Property & Theft Crime",
    "anti-social-behaviour": "Quality of Life & Public Order",
    "public-order": "Quality of Life & Public Order",
    "criminal-damage-arson": "Quality of Life & Public Order",
    "drugs": "Quality of Life & Public Order",
    "other-crime": "Other",
    "all-crime": "Other",
}

CRIME_SLUGS = [
    "anti_social_behaviour",
    "bicycle_theft",
    "burglary",
    "criminal_damage_arson",
    "drugs",
    "other_crime",
    "other_theft",
    "possession_of_weapons",
    "public_order",
    "robbery",
    "shoplifting",
    "theft_from_the_person",
    "vehicle_crime",
    "violent_crime",
]

# Order in which presence labels follow the line names of the stops matrix.
NETWORK_LABELS = [
    ("dlr_count", "DLR"),
    ("tramlink_count", "Tramlink"),
    ("elizabeth_count", "Elizabeth"),
    ("overground_count", "Overground"),
    ("bus_count", "Bus"),
]

# ---- Filters ----------------------------------------------------------------

by_code = keep_values("ons_code", AREA_CODES)
by_name = keep_values("borough_name", BOROUGH_NAMES)


def place_in(boroughs):
    """Steps that turn grid points into lon/lat with the borough they lie in."""

    def locate(df):
        return drop_layer_attributes(points_in_polygons(df, boroughs, ["BOROUGH"]))

    return (grid_to_lonlat, locate)


def audit_at(first: int) -> list[tuple]:
    """The four audit fields, which follow a file's ``first`` data columns."""
    return [
        (first, "_source_file", "STRING"),
        (first + 1, "_sheet_name", "STRING"),
        (first + 2, "_ingested_at", "DATETIME"),
        (first + 3, "_row_number", "INTEGER"),
    ]


# ---- Fixed values: record ranges, positions, names and types ---------------

EDUCATION_LAYOUTS = [
    layout("school_location_data", 2, 52403, [
        (0, "unique_reference_number", "INTEGER"),
        (2, "borough_name", "STRING"),
        (101, "ons_code", "STRING"),
        (6, "type_of_establishment", "STRING"),
        (8, "establishment_group", "STRING"),
        (10, "status", "STRING"),
        (19, "stat_low_age", "INTEGER"),
        (20, "stat_high_age", "INTEGER"),
        (35, "pupil_capacity", "INTEGER"),
        (39, "current_pupils", "INTEGER"),
        *audit_at(135),
    ], [by_code]),
    layout("school_ofsted_inspection", 5, 21996, [
        (1, "unique_reference_number", "INTEGER"),
        (4, "ofsted_phase", "STRING"),
        (14, "borough_name", "STRING"),
        (45, "previous_urn", "INTEGER"),
        (52, "quality_of_education", "INTEGER"),
        (53, "behaviour_and_attitudes", "INTEGER"),
        (54, "personal_development", "INTEGER"),
        (55, "effectiveness_of_leadership_and_management", "INTEGER"),
        *audit_at(76),
    ], [by_name]),
]

HOUSING_LAYOUTS = [
    layout("housing_stock", 6, 336, [
        (1, "ons_code", "STRING"),
        (2, "Area", "STRING"),
        (3, "local_authority", "FLOAT"),
        (4, "private_registered_provider", "FLOAT"),
        (5, "Other public sector ", "FLOAT"),
        (6, "private_sector", "FLOAT"),
        (7, "total_dwellings", "FLOAT"),
        *audit_at(8),
    ], [by_code]),
    layout("affordable_stock_additions", 12, 300, [
        (0, "ons_code", "STRING"),
        (1, "Area", "STRING"),
        (20, "total", "INTEGER"),
        *audit_at(21),
    ], [by_code]),
    layout("council_tax_bands", 3, 38, [
        (0, "ons_code", "STRING"),
        (1, "Area", "STRING"),
        *[(2 + n, f"band_{letter}", "INTEGER") for n, letter in enumerate("abcdefgh")],
        *audit_at(10),
    ], [by_code]),
    layout("average_house_price", 6, 150302, [
        (0, "date", "DATETIME"),
        (1, "Area", "STRING"),
        (2, "ons_code", "STRING"),
        (3, "average_price", "FLOAT"),
        *audit_at(7),
    ], [by_code, anniversary()]),
    layout("net_housing_additions", 7, 430, [
        (3, "Area", "STRING"),
        (2, "ons_code", "STRING"),
        *[(23 + n, str(2021 + n), "FLOAT") for n in range(5)],
        *audit_at(28),
    ], [by_code, unpivot_years]),
]

# Where each housing table's year comes from.
HOUSING_YEARS = {
    "housing_stock": "year_name",
    "affordable_stock_additions": "year_name",
    "council_tax_bands": "year_name",
    "average_house_price": "date",
    "net_housing_additions": "year",
}

PRESSURE_LAYOUTS = [
    layout("dwelling_stock_local", 6, 336, [
        (1, "ons_code", "STRING"),
        (2, "local_authority", "STRING"),
        (7, "total_dwellings", "FLOAT"),
        *audit_at(8),
    ], [by_code]),
    layout("average_prices", 6, 150302, [
        (0, "date", "DATETIME"),
        (2, "ons_code", "STRING"),
        (3, "average_price", "FLOAT"),
        *audit_at(7),
    ], [by_code, anniversary()]),
]

BUDGET_LAYOUT = layout("council_budget", 11, 424, [
    (1, "ons_code", "STRING"),
    (2, "local_authority", "STRING"),
    (12, "total_education_services", "FLOAT"),
    (28, "total_highways_and_transport_services", "FLOAT"),
    *audit_at(212),
], [by_code])

POPULATION_LAYOUT = layout("population", 2, 1718, [
    (0, "ons_code", "STRING"),
    (1, "local_authority", "STRING"),
    (2, "year", "INTEGER"),
    (4, "population", "INTEGER"),
    *audit_at(10),
], [year_range(2023, 2026), by_code])

# Stop tables: last record, data columns of the file, and fields behind X and Y.
STOP_TABLES = {
    "bus_stop_data": (21518, 15, [(3, "stop_name", "STRING"), (13, "postcode", "STRING")]),
    "dlr_stop_data": (48, 8, [(3, "stop_name", "STRING")]),
    "elizabeth_stop_data": (44, 8, [(3, "stop_name", "STRING")]),
    "overground_stop_data": (115, 8, [(3, "stop_name", "STRING")]),
    "tramlink_stop_data": (42, 8, [(3, "stop_name", "STRING")]),
    "tube_stop_data": (276, 12, [(3, "stop_name", "STRING"), (4, "line_name", "STRING")]),
}

PTAL_LAYOUT = layout("ptal_data", 2, 36, [
    (0, "ons_code", "STRING"),
    (1, "BOROUGH", "STRING"),
    (2, "avg_ptal", "FLOAT"),
    (3, "ptal", "STRING"),
    *audit_at(4),
])


def stop_layouts(boroughs) -> list:
    """Layouts of the stop tables, located in a borough polygon layer."""
    return [
        layout(table, 2, end, [(0, "X", "FLOAT"), (1, "Y", "FLOAT"), *extra, *audit_at(width)], place_in(boroughs))
        for table, (end, width, extra) in STOP_TABLES.items()
    ]


# ---- Fixed values: metric rules ---------------------------------------------

GRADED = ["quality_of_education", "behaviour_and_attitudes", "personal_development", "effectiveness_of_leadership_and_management"]

EDUCATION_GOLD = {
    "table_name": "education",
    "grain": ["borough_name", "ons_code"],
    "metric_sources": [
        {
            "source": "school_with_ofsted",
            "join_on": {"borough_name": "borough_name"},
            "filter_out": [
                {"column": "status", "values": ["Closed"]},
                {
                    "column": "establishment_group",
                    "values": ["Online provider", "Other types", "Special schools", "Universities"],
                },
                {"column": "type_of_establishment", "values": ["Pupil referral unit"]},
            ],
            "conditional_aggregations": [
                {
                    "filter_column": "establishment_group",
                    "filter_value": "Independent schools",
                    "group_by": "borough_name",
                    "count_column_name": "independent_school_count",
                    "aggregations": {
                        "pupil_capacity": {"operation": "sum", "output_name": "independent_pupil_capacity"},
                        "current_pupils": {"operation": "sum", "output_name": "independent_current_pupils"},
                    },
                },
                {
                    "filter_column": "establishment_group",
                    "filter_value": ["Local authority maintained schools", "Free Schools", "Colleges", "Academies"],
                    "group_by": "borough_name",
                    "count_column_name": "public_funded_school_count",
                    "aggregations": {
                        "pupil_capacity": {"operation": "sum", "output_name": "public_funded_pupil_capacity"},
                        "current_pupils": {"operation": "sum", "output_name": "public_funded_current_pupils"},
                        "ofsted_phase": [
                            {"operation": "count_where", "value": phase, "output_name": f"public_funded_{phase.lower()}"}
                            for phase in ("Nursery", "Primary", "Secondary")
                        ],
                        **{g: {"operation": "graded_average", "output_name": f"avg_{g}"} for g in GRADED},
                    },
                },
            ],
            "sum_columns": [
                {
                    "inputs": ["independent_school_count", "public_funded_school_count"],
                    "output_name": "total_school_count",
                },
            ],
            "calculate_ratio": [
                {
                    "numerator_col": "independent_school_count",
                    "denominator_col": "total_school_count",
                    "output_col": "pct_of_total_schools_private",
                },
                {
                    "numerator_col": "public_funded_current_pupils",
                    "denominator_col": "public_funded_pupil_capacity",
                    "output_col": "public_funded_pct_capacity_filled",
                },
                {
                    "numerator_col": "independent_current_pupils",
                    "denominator_col": "independent_pupil_capacity",
                    "output_col": "independent_pct_capacity_filled",
                },
            ],
            "calculate_deviation": [
                {"target_col": f"avg_{g}", "new_avg_col": f"lon_avg_{g}", "new_dev_col": f"pct_diff_{g}"} for g in GRADED
            ],
            "keep_cols": [
                "borough_name",
                "independent_pupil_capacity",
                "independent_current_pupils",
                "independent_school_count",
                "public_funded_pupil_capacity",
                "public_funded_current_pupils",
                "public_funded_nursery",
                "public_funded_primary",
                "public_funded_secondary",
                *[f"avg_{g}" for g in GRADED],
                "public_funded_school_count",
                "total_school_count",
                "pct_of_total_schools_private",
                "public_funded_pct_capacity_filled",
                "independent_pct_capacity_filled",
            ],
        },
    ],
}

# Metric column -> names of its mean and its deviation.
HOUSING_DEVIATIONS = {
    "average_price": ("lon_average_price", "pct_diff_average_price"),
    "total": ("lon_avg_affordable_additions", "pct_diff_affordable_additions"),
    "total_dwellings": ("lon_avg_total_dwellings", "pct_diff_total_dwellings"),
    "net_additions": ("lon_avg_net_additions", "pct_diff_net_additions"),
    "band_d": ("lon_avg_band_d", "pct_diff_band_d"),
}

HOUSING_GOLD = {
    "table_name": "housing",
    "grain": ["borough_name", "ons_code"],
    "latest": True,
    "metric_sources": [
        {
            "source": "housing_merged",
            "join_on": {"ons_code": "ons_code"},
            "rename_cols": {"total": "affordable_additions", "Area": "borough_name"},
            "keep_cols": [
                "year", "ons_code", "total_dwellings", "affordable_additions", "band_d", "average_price", "net_additions",
            ],
            "calculate_ratio": [
                {
                    "numerator_col": "total",
                    "denominator_col": "net_additions",
                    "output_col": "ratio_of_total_new_house_affordable",
                },
            ],
            "calculate_deviation": [
                {"target_col": column, "new_avg_col": mean, "new_dev_col": deviation, "group_by": ["year"]}
                for column, (mean, deviation) in HOUSING_DEVIATIONS.items()
            ],
            "calculate_yoy_change": [
                {
                    "target_col": column,
                    "group_col": "ons_code",
                    "year_col": "year",
                    "output_col": f"yoy_pct_change_{column}",
                }
                for column in ("average_price", "total_dwellings")
            ],
        },
    ],
}


def _stop_count(table: str, count: str, **more) -> dict:
    return {
        "source": table,
        "join_on": {"borough_name": "BOROUGH"},
        "groupby_cols": ["BOROUGH"],
        "use_size": True,
        "rename_cols": {"size": count},
        **more,
    }


INFRASTRUCTURE_GOLD = {
    "table_name": "infrastructure",
    "grain": ["borough_name", "ons_code"],
    "finalize": "transport_line_name",
    "metric_sources": [
        {
            "source": "ptal_data",
            "join_on": {"borough_name": "BOROUGH"},
            "keep_cols": ["BOROUGH", "avg_ptal", "ptal"],
            "calculate_deviation": {
                "target_col": "avg_ptal",
                "new_avg_col": "lon_avg_ptal_score",
                "new_dev_col": "pct_diff_from_avg",
            },
        },
        _stop_count("bus_stop_data", "bus_count"),
        _stop_count("elizabeth_stop_data", "elizabeth_count"),
        _stop_count("overground_stop_data", "overground_count"),
        _stop_count("tramlink_stop_data", "tramlink_count"),
        _stop_count("dlr_stop_data", "dlr_count"),
        _stop_count("tube_stop_data", "tube_count", textual_col="line_name"),
    ],
}


def event_gold_rules(slugs, entity: str, year: str = "year", population: str = "population", what: str = "crimes", prefix: str = "lon_avg") -> dict:
    """Rules of an event matrix: total, rates per 1,000, deviation by year, change by year."""
    rates = [(f"{s}_annualised_rate", f"{s}_per_1000") for s in slugs]
    measures = [f"total_{what}_per_1000", *[per for _, per in rates]]
    return {
        "sum_columns": [{"inputs": [rate for rate, _ in rates], "output_name": f"total_{what}_annualised"}],
        "calculate_ratio_per_1k": [
            {"numerator_col": rate, "denominator_col": population, "output_col": per}
            for rate, per in [(f"total_{what}_annualised", f"total_{what}_per_1000"), *rates]
        ],
        "calculate_deviation": [
            {"target_col": m, "new_avg_col": f"{prefix}_{m}", "new_dev_col": f"pct_diff_{m}", "group_by": [year]}
            for m in measures
        ],
        "calculate_yoy_change": [
            {"target_col": m, "group_col": entity, "year_col": year, "output_col": f"yoy_pct_change_{m}"} for m in measures
        ],
    }


POLICE_GOLD = {
    "table_name": "police",
    "grain": ["borough_name", "ons_code"],
    "latest": True,
    "metric_sources": [
        {
            "source": "population",
            "join_on": {"ons_code": "ons_code"},
            "keep_cols": ["ons_code", "population", "year"],
        },
        {
            "source": "crimes",
            "join_on": {"borough_name": "borough", "year": "year"},
            "pivot": CRIME_SLUGS,
            "keep_cols": ["borough", "year", *[f"{s}_annualised_rate" for s in CRIME_SLUGS]],
        },
    ],
    "post_processing": event_gold_rules(CRIME_SLUGS, "borough_name"),
}

# Serving tables: key columns, required columns and column defaults.
SERVING_TABLES = {
    "boroughs": {"keys": ["ons_code"], "required": ["name"]},
    "borough_education": {
        "keys": ["ons_code"],
        "defaults": {
            "public_funded_nursery": 0,
            "public_funded_primary": 0,
            "public_funded_secondary": 0,
            "public_funded_school_count": 0,
            "total_school_count": 0.0,
        },
    },
    "borough_housing": {"keys": ["ons_code"]},
    "borough_infrastructure": {
        "keys": ["ons_code"],
        "defaults": {
            "bus_count": 0,
            "dlr_count": 0,
            "elizabeth_count": 0,
            "overground_count": 0,
            "tramlink_count": 0,
            "tube_count": 0,
        },
    },
    "borough_police": {"keys": ["ons_code"]},
    "borough_housing_historical": {"keys": ["ons_code", "year"], "required": ["ons_code", "year"]},
    "borough_police_historical": {"keys": ["ons_code", "year"], "required": ["ons_code", "year"]},
}
