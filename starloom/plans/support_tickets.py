"""Sources and target tables of the support-ticket warehouse."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from starloom.functions.rules import date_ok, email_ok, in_range, one_of, phone_ok
from starloom.plans.build import Model
from starloom.specs import (
    DYNAMIC_DIMENSION,
    FACT,
    STATIC_DIMENSION,
    Arithmetic,
    Compare,
    DateDiff,
    DateKey,
    DimRef,
    Expr,
    JoinStep,
    Rule,
    SourceSpec,
    TableSpec,
    Term,
    columns,
)


# File names, columns, required and personal fields of the raw files.
SOURCES = {
    s.name: s
    for s in (
        SourceSpec(
            "agents",
            "agents.csv",
            columns(
                "agent_id int, agent_name string, agent_email string, agent_phone bigint, team_id int, "
                "skill_level string, hire_date date, avg_handle_time_min int, resolution_rate double, "
                "csat_score double, is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
            ),
            required=("agent_id", "agent_name", "agent_email", "agent_phone", "hire_date"),
            pii=("agent_email", "agent_phone"),
        ),
        SourceSpec(
            "teams", "teams.csv", columns("team_id int, team_name string"), required=("team_id", "team_name"), dynamic=False
        ),
        SourceSpec(
            "customers",
            "customers.csv",
            columns(
                "customer_id int, full_name string, email string, phone bigint, region_id double, segment_id int, "
                "signup_date date, gender string, created_at timestamp_ntz, updated_at timestamp_ntz, "
                "surrogate_key string, is_current boolean, valid_from date, valid_to date"
            ),
            required=("customer_id", "full_name", "email", "phone"),
            pii=("email", "phone"),
        ),
        SourceSpec(
            "segments",
            "segments.csv",
            columns("segment_id int, segment_name string, discount_pct int, priority_support boolean"),
            required=("segment_id", "segment_name", "discount_pct", "priority_support"),
            dynamic=False,
        ),
        SourceSpec(
            "cities",
            "cities.json",
            columns("city_id int, city_name string, country string, timezone string"),
            required=("city_id", "city_name", "country", "timezone"),
            dynamic=False,
        ),
        SourceSpec(
            "regions",
            "regions.csv",
            columns("region_id int, region_name string, city_id int, delivery_base_fee double"),
            required=("region_id", "region_name", "city_id", "delivery_base_fee"),
            dynamic=False,
        ),
        SourceSpec(
            "restaurants",
            "restaurants.json",
            columns(
                "restaurant_id int, restaurant_name string, region_id int, category_id int, price_tier string, "
                "rating_avg double, prep_time_avg_min int, is_active boolean, created_at timestamp_ntz, "
                "updated_at timestamp_ntz, surrogate_key string, is_current boolean, valid_from date, valid_to date"
            ),
            required=("restaurant_id", "restaurant_name", "is_active"),
        ),
        SourceSpec(
            "categories",
            "categories.csv",
            columns("category_id int, category_name string"),
            required=("category_id", "category_name"),
            dynamic=False,
        ),
        SourceSpec(
            "channels",
            "channels.csv",
            columns("channel_id int, channel_name string"),
            required=("channel_id", "channel_name"),
            dynamic=False,
        ),
        SourceSpec(
            "drivers",
            "drivers.csv",
            columns(
                "driver_id int, driver_name string, driver_phone bigint, national_id bigint, region_id int, "
                "shift string, vehicle_type string, hire_date date, rating_avg double, on_time_rate double, "
                "cancel_rate double, completed_deliveries int, is_active boolean, created_at timestamp_ntz, "
                "updated_at timestamp_ntz, surrogate_key string, is_current boolean, valid_from date, valid_to date"
            ),
            required=("driver_id", "driver_name", "driver_phone", "hire_date", "is_active"),
            pii=("driver_phone", "national_id"),
        ),
        SourceSpec(
            "priorities",
            "priorities.csv",
            columns(
                "priority_id int, priority_code string, priority_name string, sla_first_response_min int, "
                "sla_resolution_min int"
            ),
            required=("priority_id", "priority_code", "priority_name", "sla_first_response_min", "sla_resolution_min"),
            dynamic=False,
        ),
        SourceSpec(
            "reasons",
            "reasons.csv",
            columns(
                "reason_id int, reason_name string, reason_category_id int, severity_level int, typical_refund_pct double"
            ),
            required=("reason_id", "reason_name", "reason_category_id", "severity_level", "typical_refund_pct"),
            dynamic=False,
        ),
        SourceSpec(
            "reason_categories",
            "reason_categories.csv",
            columns("reason_category_id int, category_name string"),
            required=("reason_category_id", "category_name"),
            dynamic=False,
        ),
        SourceSpec(
            "orders",
            "orders.json",
            columns(
                "order_id string, customer_id int, restaurant_id int, driver_id int, region_id int, "
                "order_amount double, delivery_fee double, discount_amount int, total_amount double, "
                "order_status string, payment_method string, order_created_at string, delivered_at string"
            ),
            required=(
                "order_id", "customer_id", "restaurant_id", "driver_id", "order_amount", "delivery_fee",
                "discount_amount", "total_amount", "order_status", "payment_method", "delivered_at",
            ),
        ),
        SourceSpec(
            "tickets",
            "tickets.csv",
            columns(
                "ticket_id string, order_id string, customer_id int, driver_id int, restaurant_id int, agent_id int, "
                "reason_id int, priority_id int, channel_id int, status string, refund_amount double, "
                "created_at timestamp_ntz, first_response_at timestamp_ntz, resolved_at timestamp_ntz, "
                "sla_first_due_at timestamp_ntz, sla_resolve_due_at timestamp_ntz"
            ),
            required=(
                "ticket_id", "order_id", "customer_id", "driver_id", "restaurant_id", "agent_id", "reason_id",
                "priority_id", "channel_id", "status", "refund_amount", "created_at", "first_response_at",
                "resolved_at", "sla_first_due_at", "sla_resolve_due_at",
            ),
        ),
        SourceSpec(
            "ticket_events",
            "ticket_events.json",
            columns(
                "event_id string, ticket_id string, agent_id int, event_ts string, old_status string, "
                "new_status string, notes string"
            ),
            required=("event_id", "ticket_id", "new_status"),
        ),
    )
}

# Target tables with their joins, columns and keys.
TABLES = {
    t.name: t
    for t in (
        TableSpec(
            "AgentsDim",
            DYNAMIC_DIMENSION,
            "agent_id",
            ("agents", "teams"),
            (JoinStep("teams", "team_id", "team_id"),),
            keep=(
                "agent_id", "agent_name", "agent_email", "agent_phone", "team_name", "skill_level", "hire_date",
                "avg_handle_time_min", "resolution_rate", "csat_score", "is_active", "created_at", "updated_at",
            ),
            required=("agent_id", "agent_name", "agent_email", "agent_phone"),
            date_columns=("created_at", "updated_at"),
        ),
        TableSpec(
            "CustomersDim",
            DYNAMIC_DIMENSION,
            "customer_id",
            ("customers", "segments"),
            (JoinStep("segments", "segment_id", "segment_id"),),
            keep=(
                "customer_id", "full_name", "email", "phone", "segment_name", "signup_date", "gender",
                "priority_support", "discount_pct", "created_at", "updated_at",
            ),
            required=("customer_id", "full_name", "email", "phone"),
            date_columns=("created_at", "updated_at", "signup_date"),
        ),
        TableSpec(
            "CitiesDim",
            STATIC_DIMENSION,
            "city_id",
            ("cities",),
            keep=("city_id", "city_name", "country", "timezone"),
            required=("city_id", "city_name", "country", "timezone"),
        ),
        TableSpec(
            "RegionsDim",
            STATIC_DIMENSION,
            "region_id",
            ("regions",),
            keep=("region_id", "region_name", "city_id", "delivery_base_fee"),
            dims=(DimRef("CitiesDim", "city_id"),),
            required=("region_id", "region_name", "delivery_base_fee"),
        ),
        TableSpec(
            "RestaurantsDim",
            DYNAMIC_DIMENSION,
            "restaurant_id",
            ("restaurants", "categories"),
            (JoinStep("categories", "category_id", "category_id"),),
            keep=(
                "restaurant_id", "restaurant_name", "category_name", "price_tier", "rating_avg", "prep_time_avg_min",
                "is_active", "created_at", "updated_at",
            ),
            required=("restaurant_id", "restaurant_name", "prep_time_avg_min", "is_active"),
            date_columns=("created_at", "updated_at"),
        ),
        TableSpec(
            "ChannelsDim",
            STATIC_DIMENSION,
            "channel_id",
            ("channels",),
            keep=("channel_id", "channel_name"),
            required=("channel_id", "channel_name"),
        ),
        TableSpec(
            "DriversDim",
            DYNAMIC_DIMENSION,
            "driver_id",
            ("drivers",),
            keep=(
                "driver_id", "driver_name", "driver_phone", "national_id", "shift", "vehicle_type", "hire_date",
                "rating_avg", "on_time_rate", "cancel_rate", "completed_deliveries", "is_active", "created_at",
                "updated_at",
            ),
            required=("driver_id", "driver_name", "driver_phone", "hire_date", "is_active"),
            date_columns=("created_at", "updated_at"),
        ),
        TableSpec(
            "ReasonsDim",
            STATIC_DIMENSION,
            "reason_id",
            ("reasons", "reason_categories"),
            (JoinStep("reason_categories", "reason_category_id", "reason_category_id"),),
            renamed={"category_name": "reason_category_name"},
            keep=("reason_id", "reason_name", "reason_category_name", "severity_level", "typical_refund_pct"),
            required=("reason_id", "reason_name", "severity_level", "typical_refund_pct"),
        ),
        TableSpec("DateDim", DYNAMIC_DIMENSION, "date_id", generated=True),
        TableSpec(
            "FactTickets",
            FACT,
            "ticket_id",
            ("tickets", "orders", "ticket_events"),
            (JoinStep("orders", "order_id", "order_id"), JoinStep("ticket_events", "ticket_id", "ticket_id")),
            derived=(
                DateDiff("resolution_time_min", end="resolved_at", start="created_at", unit="m"),
                DateDiff("first_response_time_min", end="first_response_at", start="created_at", unit="m"),
                Compare("sla_first_response_breached", "first_response_at", ">", "sla_first_due_at"),
                Compare("sla_resolution_breached", "resolved_at", ">", "sla_resolve_due_at"),
                Arithmetic("revenue_impact", (Term("refund_amount"), Term("discount_amount"))),
                DateKey("date_key_created", "created_at"),
                DateKey("date_key_first_response", "first_response_at"),
                DateKey("date_key_resolved", "resolved_at"),
            ),
            # the fact's status is the event's new status, not the ticket's own
            renamed={"status": "ticket_status", "new_status": "status"},
            keep=(
                "ticket_id", "order_id", "customer_id", "agent_id", "driver_id", "restaurant_id", "region_id",
                "reason_id", "channel_id", "refund_amount", "date_key_created", "date_key_first_response",
                "resolution_time_min", "first_response_time_min", "sla_first_response_breached",
                "sla_resolution_breached", "date_key_resolved", "order_amount", "delivery_fee", "discount_amount",
                "total_amount", "revenue_impact", "status",
            ),
            dims=(
                DimRef("CustomersDim", "customer_id"),
                DimRef("AgentsDim", "agent_id"),
                DimRef("DriversDim", "driver_id"),
                DimRef("RestaurantsDim", "restaurant_id"),
                DimRef("RegionsDim", "region_id"),
                DimRef("ReasonsDim", "reason_id"),
                DimRef("ChannelsDim", "channel_id"),
                DimRef("DateDim", ("date_key_created", "date_key_first_response", "date_key_resolved"), "date_id"),
            ),
            date_columns=("date_key_created", "date_key_first_response", "date_key_resolved"),
            partition_by=("date_key_created",),
        ),
    )
}

MODEL = Model(SOURCES, TABLES)

# The documented row rules, the columns whose history is kept, and the statuses of tickets.
STATUSES = ("open", "pending", "resolved", "closed")
TRACKED_CUSTOMER = ("full_name", "email", "phone", "segment_name")
RULES = {
    "agents": (("email format", "agent_email", email_ok), ("phone format", "agent_phone", phone_ok), ("date", "hire_date", date_ok)),
    "customers": (("email format", "email", email_ok), ("phone format", "phone", phone_ok), ("date", "signup_date", date_ok)),
    "drivers": (("phone format", "driver_phone", phone_ok), ("rating range", "rating_avg", lambda c: in_range(c.try_cast("double"), 0, 5))),
    "restaurants": (("rating range", "rating_avg", lambda c: in_range(c.try_cast("double"), 0, 5)),),
    "orders": tuple((f"{c} range", c, lambda x: in_range(x.try_cast("double"), 0)) for c in ("order_amount", "delivery_fee", "discount_amount", "total_amount")),
    "tickets": (("status values", "status", lambda c: one_of(F.lower(c), STATUSES)), ("refund range", "refund_amount", lambda c: in_range(c.try_cast("double"), 0))),
}


def documented_model() -> Model:
    """``MODEL`` with all that is documented for it: row rules, history of customers, reopened tickets.

    The event of a ticket carries its old and its new status; a ticket that leaves a closed status for an open one is
    reopened.
    """
    sources = {n: replace(s, rules=tuple(Rule(*r) for r in RULES[n])) if n in RULES else s for n, s in SOURCES.items()}
    fact = TABLES["FactTickets"]
    reopened = Expr("is_reopened", "coalesce(old_status in ('resolved', 'closed') and new_status in ('open', 'reopened'), false)")
    changed = {
        "CustomersDim": replace(TABLES["CustomersDim"], tracked=TRACKED_CUSTOMER),
        "FactTickets": replace(fact, derived=(*fact.derived, reopened), keep=(*fact.keep, "is_reopened")),
    }
    return Model(sources, {**TABLES, **changed})
