"""Delivery-time analytics for e-commerce orders, written as Spark jobs."""
