"""ordermill: sales-order analytics as lazy DataFrame operators for Spark."""
