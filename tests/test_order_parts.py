"""Parts of the order table that need nothing of each other are built at once."""

import threading

import pytest

from orderlens.plans import features as ft


def test_conditions_do_not_wait_for_the_orders_sums(spark, monkeypatch):
    begun = threading.Event()

    class Stop(Exception):
        pass

    def sums(*_):
        begun.set()
        raise Stop

    def conditions(*_):
        assert begun.wait(60)
        raise Stop

    monkeypatch.setattr(ft, "with_payment", sums)
    monkeypatch.setattr(ft, "conditions", conditions)
    point = "City string, Latitude double, Longitude double"
    t = {
        "orders": spark.createDataFrame([], "OrderID long, CustomerID long, RestaurantID long, DeliveryPartnerID long, OrderDate date, OrderTime string"),
        "restaurants": spark.createDataFrame([], f"RestaurantID long, RestaurantName string, Area string, Cuisine string, Rating double, AverageCost double, RestaurantType string, {point}"),
        "customers": spark.createDataFrame([], "CustomerID long, City string, Age int, Membership string, RegistrationDate date, Gender string"),
        "delivery_partners": spark.createDataFrame([], "DeliveryPartnerID long, City string, VehicleType string, Rating double, AverageDeliveryTime double, CompletedDeliveries int"),
        "order_items": spark.createDataFrame([], "OrderID long, Quantity int"),
        "customer_feedback": spark.createDataFrame([], "OrderID long, CustomerRating int, DeliveryRating int, FoodRating int, Sentiment string"),
    }
    with pytest.raises(Stop):
        ft.order_base_table(t)
