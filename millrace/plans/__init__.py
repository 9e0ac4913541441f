"""Views, reports and the registered queries."""
