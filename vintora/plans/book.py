"""The tables of one credit book, each derived once from the staging tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from vintora.params import SAMPLE, Terms
from vintora.plans import contest, credit, risk, sales
from vintora.session import prepare
from vintora.sources import normalise
from vintora.sources.shop import Shop


class Book:
    """Lazy tables over a source with the staging tables as attributes."""

    def __init__(self, source, terms: Terms = SAMPLE):
        self.source, self.terms = source, terms

    @classmethod
    def open(cls, spark: SparkSession, sf_dir: str, terms: Terms = SAMPLE) -> "Book":
        return cls(Shop(prepare(spark), sf_dir), terms)

    # -- clean inputs

    @cached_property
    def lines(self) -> DataFrame:
        return normalise.order_lines(self.source.credit_order)

    @cached_property
    def payments(self) -> DataFrame:
        return normalise.payments(self.source.payment_report)

    @cached_property
    def mirrors(self) -> DataFrame:
        return normalise.mirrors(self.source.mirror_transaction)

    @cached_property
    def deliveries(self) -> DataFrame:
        return normalise.deliveries(self.source.state_of_delivery)

    @cached_property
    def approvals(self) -> DataFrame:
        return normalise.approvals(self.source.credit_approval)

    @cached_property
    def pre_approvals(self) -> DataFrame:
        return normalise.pre_approvals(self.source.pre_authorization)

    @cached_property
    def limits(self) -> DataFrame:
        return normalise.limits(self.source.credit_limit_history)

    @cached_property
    def sales(self) -> DataFrame:
        return normalise.yearly_sales([self.source.orders_old], [self.source.orders_new],
                                      self.terms)

    @cached_property
    def new_sales(self) -> DataFrame:
        return normalise.yearly_sales([], [self.source.orders_new], self.terms)

    # -- routes

    @cached_property
    def tranches(self) -> DataFrame:
        return credit.route_tranches(normalise.route_days(self.source.route_days))

    @cached_property
    def spans(self) -> DataFrame:
        return credit.route_spans(self.tranches)

    @cached_property
    def routes(self) -> DataFrame:
        return credit.current_routes(
            normalise.known(self.source.commercial_structure, "netsuite_id"),
            normalise.known(self.source.route_mapping, "ruta"))

    # -- credit

    @cached_property
    def indexed(self) -> DataFrame:
        return credit.indexed_orders(self.lines)

    @cached_property
    def orders(self) -> DataFrame:
        return credit.grouped_orders(self.indexed, self.approvals, self.payments, self.deliveries,
                                     self.spans)

    @cached_property
    def valid_lines(self) -> DataFrame:
        return credit.valid_lines(self.lines)

    @cached_property
    def order_keys(self) -> DataFrame:
        return credit.order_keys(self.lines)

    @cached_property
    def loan_keys(self) -> DataFrame:
        """The order keys again, from the orders instead of their lines."""
        return credit.order_keys(self.indexed)

    @cached_property
    def loans(self) -> DataFrame:
        return credit.loans(self.orders, self.payments, self.mirrors, self.loan_keys, self.terms)

    @cached_property
    def loan_core(self) -> DataFrame:
        return credit.loan_core(self.indexed, self.payments, self.mirrors, self.loan_keys,
                                self.terms)

    @cached_property
    def snapshot(self) -> DataFrame:
        return credit.month_end_snapshot(self.loans, self.due_months)

    @cached_property
    def due_months(self) -> DataFrame:
        return credit.due_months(self.indexed, self.terms)

    @cached_property
    def vintage(self) -> DataFrame:
        return credit.loan_vintage(self.loans, self.due_months, self.terms)

    @cached_property
    def revenue(self) -> DataFrame:
        return credit.revenue(self.loans, self.terms)

    @cached_property
    def grid(self) -> DataFrame:
        return credit.customer_grid(
            self.source.customers, self.source.credit_request, self.routes, self.pre_approvals,
            self.limits, self.approvals, self.orders, self.payments, self.terms)

    @cached_property
    def unique_grid(self) -> DataFrame:
        return credit.unique_grid(self.grid)

    @cached_property
    def daily(self) -> DataFrame:
        return credit.daily_kpis(self.orders, self.deliveries, self.loans, self.approvals,
                                 self.source.customers, self.terms)

    @cached_property
    def cut_lines(self) -> DataFrame:
        return credit.weekly_lines(self.lines, self.routes, self.terms)

    @cached_property
    def cut_orders(self) -> DataFrame:
        return credit.weekly_orders(self.cut_lines)

    # -- all sales

    @cached_property
    def universe(self) -> DataFrame:
        return sales.universe(self.approvals, self.valid_lines)

    @cached_property
    def history(self) -> DataFrame:
        return sales.sales_history(self.sales, self.universe, self.terms)

    @cached_property
    def order_months(self) -> DataFrame:
        return sales.order_months(self.sales)

    @cached_property
    def panel(self) -> DataFrame:
        return sales.cohort_panel(self.order_months, sales.first_credit_months(self.valid_lines))

    @cached_property
    def season(self) -> DataFrame:
        return sales.month_seasonality(self.order_months)

    @cached_property
    def lifecycle(self) -> DataFrame:
        return sales.lifecycle(credit.collapse_lines(self.lines), self.terms)

    @cached_property
    def pre_post(self) -> DataFrame:
        return sales.pre_post(self.history, self.members, self.valid_lines, self.terms)

    @cached_property
    def members(self) -> DataFrame:
        """Customers with enrolment and current route, the part of the grid others need."""
        return credit.members(self.source.customers, self.approvals, self.routes)

    @cached_property
    def monthly_channels(self) -> DataFrame:
        return sales.by_customer_month_channel(self.new_sales)

    # -- risk and contest

    @cached_property
    def matured(self) -> DataFrame:
        return risk.matured_profile(self.loans, self.grid, self.orders, self.history, self.terms)

    @cached_property
    def profile(self) -> DataFrame:
        return risk.numbered(self.matured)

    @cached_property
    def odds(self) -> DataFrame:
        return risk.distance_odds(self.loan_core, self.grid, self.terms)

    @cached_property
    def pairs(self) -> DataFrame:
        return risk.pair_odds(self.loan_core, self.grid, self.terms)

    @cached_property
    def contest(self) -> DataFrame:
        return contest.contest(self.orders, self.grid, self.routes, self.terms)
