"""Named analyses over tables in the shape of a sales star, a rental shop or an order book."""
